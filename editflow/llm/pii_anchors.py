"""Personal data by anchor expansion: an Aho-Corasick automaton finds at-signs, schemes, digit pairs
and identifier cues; local parsers grow each anchor to its boundaries and validate it.

Everything happens within a row: no shuffle, one pass over each text, and work that is linear in its
length (parsers of base kinds keep a cursor; the values of cues and schemes end where the next could start).
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, then the kinds that this method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("address", "account")
KINDS = BASE_KINDS + ADDED_KINDS

# Characters and shapes of the base kinds.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(\.[0-9]+)*")
DIGIT_CHAIN = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What the method adds: addresses behind a scheme that name a person (user part, mailbox, telephone)
# and identifiers behind a cue. Each value has to pass its own shape, so a cue in prose adds nothing.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:")
USER_HOST = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*(:[0-9]{1,5})?")
MAILBOX = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*")
TELEPHONE = re.compile(r"\+?[0-9][0-9().-]{5,24}")
CUES = ("password", "passwd", "pwd", "token", "api_key", "api key", "apikey", "secret", "account", "acct",
        "passport", "user id", "username", "login")
CUE_VALUE = re.compile(r"(?:[ ]?(?:no\.?|number|id|key))?[ ]{0,2}[:=#][ ]{0,2}[\"']?([A-Za-z0-9_+/.-]{6,})")
IBAN = re.compile(r"[ :=#.]{0,4}([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
SOCIAL = re.compile(r"(?:[ ]?(?:no\.?|number))?[ :=#]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
KEY_ID = re.compile(r"A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])")
HANDLE = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,30}(?![A-Za-z0-9_@.-])")


def _cases(word: str) -> set[str]:
    return {word, word.upper(), word.capitalize()}


def _automaton() -> ahocorasick.Automaton:
    """Anchors with (parser, length): at-signs, schemes, cues, and pairs that begin a number of some kind."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    for x in DIGITS:
        a.add_word("+" + x, ("phone", 2))
        for y in DIGITS:
            a.add_word(f"{x}.{y}", ("ip", 3))
            for gap in ("", " ", "-"):
                a.add_word(x + gap + y, ("card", 2 + len(gap)))
    for scheme in SCHEMES:
        for s in {scheme, scheme.upper()}:
            a.add_word(s, ("scheme", len(s)))
    for parser, cues in (("cue", CUES), ("iban", ("iban",)), ("social", ("ssn", "social security"))):
        for cue in cues:
            for c in _cases(cue):
                a.add_word(c, (parser, len(c)))
    for prefix in ("AKIA", "ASIA"):
        a.add_word(prefix, ("key", 4))
    a.make_automaton()
    return a


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def _iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _numbers(text: str, spans: list, start: int, kind: str, cursor: int) -> int:
    """Grow an anchor at ``start`` to its chain of digits; add what is valid; return where the chain ends."""
    if kind == "card":
        m = DIGIT_CHAIN.match(text, start)
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), "card", m.end()))
        return m.end()
    if kind == "phone":
        m = PHONE.match(text, start)
        if m is None:
            return start + 1
        if 9 <= sum(c in DIGITS for c in m.group()) <= 15:
            spans.append((start, "phone", m.end()))
        return m.end()
    while start > cursor and text[start - 1] in DIGITS:
        start -= 1
    m = DOTTED.match(text, start)
    parts = m.group().split(".")
    at = start
    for k in range(0, len(parts) - 3, 4):  # a place takes four parts, whether they are valid or not
        four = parts[k:k + 4]
        end = at + sum(map(len, four)) + 3
        if all(map(_octet, four)):
            spans.append((at, "ip", end))
        at = end + 1
    return m.end()


def _free(text: str, at: int) -> bool:
    """Nothing of a word stands right before ``at``."""
    return at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "_")


def _cued(text: str, spans: list, start: int, end: int, parser: str) -> None:
    """Identifiers behind a cue at [start, end)."""
    if not _free(text, start):
        return
    if parser == "key":
        m = KEY_ID.match(text, start)
        span = m and m.span()
    elif parser == "iban":
        m = IBAN.match(text, end)
        span = m and _iban(m.group(1)) and m.span(1)
    elif parser == "social":
        m = SOCIAL.match(text, end)
        span = m and m.span(1)
    else:
        m = CUE_VALUE.match(text, end)
        value = m.group(1).rstrip(".-") if m else ""
        good = len(value) >= 6 and any(c in DIGITS for c in value)
        span = good and (m.start(1), m.start(1) + len(value))
    if span:
        spans.append((span[0], "account", span[1]))


def _scheme(text: str, spans: list, start: int, end: int) -> None:
    if not _free(text, start):
        return
    name = text[start:end].lower()
    shape = MAILBOX if name == "mailto:" else TELEPHONE if name == "tel:" else USER_HOST
    m = shape.match(text, end)
    if m is None or (name == "tel:" and not 7 <= sum(c in DIGITS for c in m.group()) <= 15):
        return
    spans.append((start, "address", start + len(text[start:m.end()].rstrip(".,;:-("))))


def spans_of(text: str | None, automaton: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """All spans ``(start, kind, end)`` of a text, by start and kind; code points, end exclusive."""
    if not text:
        return []
    spans: list[tuple[int, str, int]] = []
    cursor = dict.fromkeys(BASE_KINDS, 0)  # places of a base kind don't overlap
    last_at = -1
    for last, (parser, length) in automaton.iter(text):
        start = last - length + 1
        if parser == "at":
            low = max(cursor["email"], last_at + 1)
            before = text[low:start]
            local = len(before) - len(before.rstrip(LOCAL))
            domain = DOMAIN.match(text, start + 1) if local else None
            if domain:
                spans.append((start - local, "email", domain.end()))
                cursor["email"] = domain.end()
            elif start == 0 or text[start - 1] not in LOCAL and _free(text, start):
                handle = HANDLE.match(text, start + 1)
                if handle:
                    spans.append((start, "account", handle.end()))
            last_at = start
        elif parser == "scheme":
            _scheme(text, spans, start, last + 1)
        elif parser not in cursor:
            _cued(text, spans, start, last + 1, parser)
        elif start >= cursor[parser]:
            cursor[parser] = _numbers(text, spans, start, parser, cursor[parser])
    return sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def _finder() -> Callable[[Column], Column]:
    held: list[ahocorasick.Automaton] = []  # built once in each worker

    @F.pandas_udf(SPANS)
    def find_spans(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(_automaton())
        return pd.Series([[{"kind": k, "start": s, "end": e} for s, k, e in spans_of(t, held[0])] for t in texts],
                         dtype=object)

    return find_spans


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``pii_spans``: an array of (kind, start, end), by start and kind, in code points.

    Base kinds (email, ip, card, phone) are the leftmost non-overlapping places of their patterns that
    pass their checks; spans of different kinds may overlap. Added kinds: ``address`` (a scheme
    followed by a user part, a mailbox or a telephone number) and ``account`` (handles, key ids and
    identifiers behind a cue). Null and empty texts have no span. Every row has its own result, repeated
    ids and rows too. All columns are kept; one that is called ``pii_spans`` is replaced. An empty
    table gives an empty table.
    """
    return docs.withColumn("pii_spans", _finder()(F.col(text_col)))


def joined(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined in their order."""
    of = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``find`` replaced by its kind in angle brackets; null stays null.

    Overlapping spans become one replacement with the kind of the first of them.
    """
    held: list[ahocorasick.Automaton] = []

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(_automaton())

        def one(text):
            if text is None:
                return None
            out, at = [], 0
            for start, kind, end in spans_of(text, held[0]):
                if start >= at:
                    out += [text[at:start], f"<{kind}>"]
                at = max(at, end)
            return "".join([*out, text[at:]])

        return pd.Series([one(t) for t in texts], dtype=object)

    return docs.withColumn(text_col, masked(F.col(text_col)))

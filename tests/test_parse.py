"""Parser: hand-written edge rows, the one-pass/per-group paths, rejects as the complement."""

import pytest
from pyspark.sql import Row

from editflow.operators.parse import parse_edits, parse_rejects

URL = "https://example.org/w/index.php?diff=1"


def _msg(title, flags, diff, summary=" s"):
    return f"[[{title}]] {flags} {URL} * u * ({diff}){summary}"


CASES = [
    # message, expected (type, byteDiff, isNew, isMinor, isUnpatrolled, isBotEdit, summary) or None
    (_msg("T", "", "+29"), ("EDIT", 29, False, False, False, False, "s")),
    (_msg("T", "!N", "+32"), ("EDIT", 32, True, False, True, False, "s")),
    (_msg("Talk:T", "B", "-1"), ("TALK", -1, False, False, False, True, "s")),
    (_msg("Special:T", "", "+0"), ("SPECIAL", 0, False, False, False, False, "s")),
    (_msg("User talk:T", "", "+1"), ("EDIT", 1, False, False, False, False, "s")),
    (_msg("T", "", "-9", " "), ("EDIT", -9, False, False, False, False, "")),
    (_msg("T", "", "-9", ""), None),
    (_msg("T", "", "+", " s"), None),
    (_msg("T", "", " 12", " s"), None),
    (_msg("T", "", "+99999999999", " s"), None),
    (_msg("T", "M", "+5", " see [[Other]] page"), ("EDIT", 5, False, True, False, False, "see [[Other]] page")),
    (None, None),
    ("no brackets at all", None),
]


@pytest.fixture(scope="module")
def parsed_cases(spark):
    rows = [Row(i=i, message=m) for i, (m, _) in enumerate(CASES)]
    raw = spark.createDataFrame(rows, "i INT, message STRING")
    return raw, {r.i: r for r in parse_edits(raw).collect()}, {r.i for r in parse_rejects(raw).collect()}


@pytest.mark.parametrize("idx", range(len(CASES)))
def test_edge_rows(parsed_cases, idx):
    _, got, rejected = parsed_cases
    expected = CASES[idx][1]
    if expected is None:
        assert idx not in got and idx in rejected
        return
    assert idx not in rejected
    r = got[idx]
    assert (r.type, r.byteDiff, r.isNew, r.isMinor, r.isUnpatrolled, r.isBotEdit, r.summary) == expected
    assert r.user == "u" and r.diffUrl == URL


def test_greedy_title_runs_to_last_brackets(spark):
    # Greedy groups: the title runs to the last "]]" that still lets the rest match. With no
    # flags (two spaces) that is the second "]]"; with one space the flags group needs a
    # space of its own, so the match falls back to the first "]]".
    raw = spark.createDataFrame(
        [(1, "[[A]] x [[B]]  " + URL + " * u * (+1) s"), (2, "[[A]] x [[B]] " + URL + " * u * (+1) s")],
        "i INT, message STRING",
    )
    got = {r.i: r for r in parse_edits(raw).collect()}
    assert (got[1].title, got[1].diffUrl) == ("A]] x [[B", URL)
    assert (got[2].title, got[2].diffUrl) == ("A", URL)


def test_slow_path_for_line_breaks_and_separator(spark):
    """Messages with characters the one-pass path cannot carry use per-group extraction."""
    msgs = [
        _msg("T\u0001x", "", "+3"),         # separator inside the title
        _msg("T", "", "+4", " s tail"),  # Java "." stops at U+2028: summary ends there
        "junk\n" + _msg("T", "", "+5"),     # match after a line break (unanchored find)
    ]
    raw = spark.createDataFrame([(m,) for m in msgs], "message STRING")
    got = sorted((r.title, r.byteDiff, r.summary) for r in parse_edits(raw).collect())
    assert got == [("T", 4, "s"), ("T", 5, "s"), ("T\u0001x", 3, "s")]


def test_rejects_are_the_complement(spark):
    from editflow.sources.tables import read_messages

    raw = read_messages(spark, "/root/testdata/sf0.001")
    n, p, r = raw.count(), parse_edits(raw).count(), parse_rejects(raw).count()
    assert p + r == n and r > 0


def test_regex_runs_once_per_row(spark):
    """The plan keeps the regex in one projection (no filter copy of it)."""
    from editflow.sources.tables import read_messages

    df = parse_edits(read_messages(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1  # its own Project, read by the size() check and the value
    assert "Filter" not in plan
    # The generated code evaluates the one-pass regex at a single site (read without the
    # balancing exchange, so the plan is not wrapped by AQE and its code is generated now).
    narrow = parse_edits(read_messages(spark, "/root/testdata/sf0.001"))
    debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package
    assert debug.codegenString(narrow._jdf.queryExecution().executedPlan()).count("appendReplacement") == 1


# Pieces that random lines are built from: the notice's own punctuation, flag letters,
# numbers of every shape, page prefixes, plain words, and the two characters (line break,
# separator) that send a line down the per-group path. No character on which Java's and
# Python's regex classes differ (``\r``, non-ASCII) is used.
_PIECES = [
    "[[", "]]", "]] ", " ", "  ", "\t", " * ", "*", "(", ")", "(+", "+", "-", "0", "12", "007",
    "2147483647", "2147483648", "-2147483648", "99999999999", "Special:", "Talk:", "User talk:",
    "M", "!N", "B", "N", "!", "word", "x y", "https://example.org/?diff=3", "\n", "\u0001",
]


def _random_lines(n, seed=7):
    import random

    rnd = random.Random(seed)
    pick = lambda k: "".join(rnd.choice(_PIECES) for _ in range(rnd.randint(0, k)))
    lines = []
    for i in range(n):
        if i % 4 == 3:  # free soup of pieces
            lines.append(pick(14))
        else:  # the notice's shape with random slots, so many lines match
            sign = rnd.choice(["", "+", "-", "+", "", "+-"])
            number = rnd.choice(["0", "12", "7", "2147483647", "2147483648", "x", ""])
            lines.append(
                f"{pick(2)}[[{pick(3)}]]{rnd.choice([' ', ' ', '  ', ''])}{pick(2)} {pick(2)} * {pick(3)} * "
                f"({sign}{number}){rnd.choice([' ', ' ', ''])}{pick(3)}"
            )
    return lines


def _expected(message):
    """Brute force: Python's regex engine, unanchored search, then the strict integer rule."""
    import re

    from editflow.functions.parse import EDIT_PATTERN

    m = re.search(EDIT_PATTERN, message)
    if m is None or re.fullmatch(r"[+-]?[0-9]+", m.group(5)) is None:
        return None
    value = int(m.group(5))
    if not -(2**31) <= value < 2**31:
        return None
    title, flags, diff_url, user, _, summary = m.groups()
    kind = "SPECIAL" if title.startswith("Special:") else "TALK" if title.startswith("Talk:") else "EDIT"
    return (kind, title, user, diff_url, value, summary, "M" in flags, "N" in flags, "!" in flags, "B" in flags)


def test_random_lines_equal_brute_force(spark):
    lines = _random_lines(4000)
    raw = spark.createDataFrame(list(enumerate(lines)), "i INT, message STRING")
    got = {
        r.i: (r.type, r.title, r.user, r.diffUrl, r.byteDiff, r.summary, r.isMinor, r.isNew, r.isUnpatrolled, r.isBotEdit)
        for r in parse_edits(raw).collect()
    }
    want = {i: e for i, e in ((i, _expected(m)) for i, m in enumerate(lines)) if e is not None}
    assert len(want) > 500  # enough matching lines to mean something
    assert got == want
    rejected = {r.i for r in parse_rejects(raw).collect()}
    assert rejected == set(range(len(lines))) - set(want)

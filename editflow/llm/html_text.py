"""Main text of web pages: structure first, then a suffix array over each host's pages.

A page becomes blocks of text. Menus, page headers and footers, asides, forms, scripts and
what an element's class, id or role marks as such (adverts, notices, comments, ...) are left
out; if the page has an article or main element, only blocks inside count and are trusted.

Pages with equal token streams count once. The distinct streams of a host that a task reads
together are concatenated in chunks of bounded size (a mark between blocks, a mark of its own
after each page), and the suffixes sorted by their first ``run`` tokens: those that agree on all
of them are one run. Most runs are on one page only, so first only 40 bits of each run's hash are
dealt out, sorted and as differences, and counted over the whole host: no run that enough pages
hold is left out. What remains is counted exactly by the whole hash and goes back to the pages,
so that no text depends on chunks or partitions.

On pages without an article element the tokens that such runs cover go and the unique ones stay;
if more than the larger part would go, only what many pages hold. Inside an article only whole
blocks go that many pages hold, and never the larger part of the article.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved
from editflow.llm.shingles import mixed

# Element names by treatment, and words of class, id and role that mark furniture.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "math", "xmp", "noembed",
       "noframes", "object", "canvas", "video", "audio"}
TO_THE_END = {"script", "style", "title", "textarea"}  # unclosed, they take the rest of the page
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
DROPPED = {"nav", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "datalist", "map"}
PAGE_ONLY = {"header", "footer"}
MAIN = {"article", "main"}
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
         "comment", "comments", "consent", "cookie", "cookies", "discussion", "disqus", "footer", "gdpr", "login",
         "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
         "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related",
         "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
         "sponsored", "subscribe", "toolbar", "widget", "widgets", "alert", "complementary", "contentinfo", "header"}
CONTENT = {"article", "body", "content", "entry", "main", "page", "post", "story", "text", "wrapper"}
LAYOUT = {"has", "with", "no", "without", "is"}  # first words of classes that tell of other elements
OWN_HEADER = {"article", "entry", "post", "story"}  # whose header holds a text's title
# An element that starts closes an open one of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
P_CLOSERS = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure",
             "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p",
             "pre", "section", "table", "ul"}

_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[!?/][^>]*>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|(?=[\s/]|$))",
                        re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def _furniture(name: str, attributes: str, in_main: bool) -> bool:
    if name in DROPPED or (name in PAGE_ONLY and not in_main):
        return True
    if name in ("html", "body") or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    kinds: set[str] = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key in ("class", "id", "role"):
            kinds.update(_kind(token, in_main) for token in value.split())
    if "content" in kinds and name not in ("p", "span", "ul", "li"):
        return False
    return "furniture" in kinds


def _kind(token: str, in_main: bool) -> str:
    """What a class, id or role says of its element. Its last word is what the element is, the others
    say whose: ``main-menu`` is a menu, ``menu-content`` content. ``has-sidebar`` tells of another element."""
    words = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()) if w]
    if not words or words[0] in LAYOUT:
        return ""
    if words[-1] in CONTENT or words[-1] == "header" and (in_main or words[0] in OWN_HEADER):
        return "content" if words[-1] in CONTENT else ""
    return "furniture" if MARKS.intersection(words) - ({"header"} if in_main else set()) else ""


def blocks(page: str) -> tuple[list[str], bool]:
    """Text blocks of the main part, and whether an article or main element holds them."""
    lower = None
    found: list[tuple[str, bool]] = []
    words: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements and whether each is left out
    out_depth = main_depth = 0
    seen_main = False
    at, end = 0, len(page)

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            found.append((text, main_depth > 0))

    def pop_to(k: int) -> None:
        nonlocal out_depth, main_depth
        while len(stack) > k:
            name, out = stack.pop()
            out_depth -= out
            main_depth -= name in MAIN

    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not out_depth:
            piece = page[at:stop]
            if not m:
                # a tag that the end of the page cuts off is no text
                cut = re.search(r"<(?:[a-zA-Z/!?][^<]*)?$", piece)
                piece = piece[:cut.start()] if cut else piece
            words.append(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        if m.group(0) == "<!--":
            close = page.find("-->", at)
            at = end if close < 0 else close + 3
            continue
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing, attributes = bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
        if name not in INLINE and not out_depth:
            flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop_to(k)
                    break
            continue
        if name in ("svg", "math") and attributes.endswith("/"):
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            # lower() can change the length of a text only for non-ASCII characters; search again then
            close = lower.find("</" + name, at) if len(lower) == end else (
                c.start() if (c := re.compile("</" + name, re.IGNORECASE).search(page, at)) else -1)
            if close < 0 and name not in TO_THE_END:
                continue
            gt = page.find(">", close) if close >= 0 else -1
            at = end if gt < 0 else gt + 1
            continue
        if name in VOID or attributes.endswith("/") and name in ("path", "use"):
            continue
        closes = {"p"} if name in P_CLOSERS else CLOSES.get(name)
        if closes and stack:
            for k in range(len(stack) - 1, max(-1, len(stack) - 8), -1):
                if stack[k][0] in closes:
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        out = _furniture(name, attributes, main_depth > 0)
        stack.append((name, out))
        out_depth += out
        if name in MAIN:
            main_depth += 1
            seen_main = seen_main or not out_depth
    flush()
    if seen_main:
        return [t for t, inside in found if inside], True
    return [t for t, _ in found], False


BROADCAST_ROWS = 1_000_000  # 16 bytes a row: a checked bound; beyond it the join shuffles
_WORDS = 500_000  # word hashes that a task keeps
_LANES = 8  # a word of at most so many 8-byte lanes is hashed beside others; a longer one by itself
_SHORT, _BUCKET = 40, 10  # bits of a run's hash that are dealt out first, and of them the bucket's


def _word_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte strings that stand in ``data``: lane after lane of eight bytes, all strings at once."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    lanes = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # the eight bytes from each place on
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
    h = mixed(sizes.astype(np.uint64))
    at, left, of = starts, sizes, None
    for _ in range(_LANES):
        lane = lanes[at] & masks[np.minimum(left, 8)]
        if of is None:
            h = mixed(h ^ lane)
        else:
            h[of] = mixed(h[of] ^ lane)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        of, at, left = more if of is None else of[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(sizes > 8 * _LANES).tolist():
        w = data[starts[k]:starts[k] + sizes[k]].tobytes()
        h[k] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    return h


class _Hashes:
    """64-bit hashes of words and of runs of words, the same in every task."""

    def __init__(self, run: int):
        self.run, self.known = run, {}
        self.powers = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(run)], dtype=np.uint64)

    def word(self, w: bytes) -> int:
        h = self.known.get(w)
        if h is None:
            if len(self.known) >= _WORDS:
                self.known.clear()
            data = np.frombuffer(w, dtype=np.uint8)
            h = self.known[w] = int(_word_hashes(data, np.zeros(1, dtype=np.int64), np.array([len(w)]))[0])
        return h

    def pages(self, texts: list[bytes]) -> list[np.ndarray]:
        """Word hashes of each page's blocks (a line each), 0 after each block; all words are hashed together."""
        data = np.frombuffer(b"".join(t + b"\n" for t in texts if t), dtype=np.uint8)
        ends = np.flatnonzero((data == 32) | (data == 10)) + 1
        starts = np.concatenate([np.zeros(1, dtype=np.int64), ends])[:len(ends)]
        last = data[ends - 1] == 10
        after = np.cumsum(last)  # blocks that have ended with this word
        codes = np.zeros(len(ends) + int(last.sum()), dtype=np.uint64)
        codes[np.arange(len(ends)) + after - last] = _word_hashes(data, starts, ends - 1 - starts)
        bounds = np.cumsum([0, *(len(t) + 1 if t else 0 for t in texts)])
        n = np.searchsorted(ends, bounds, side="right")  # words before each page's end
        cuts = n + np.concatenate([[0], after])[n]
        return [codes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def runs(self, pages: list[np.ndarray], hosts: list[str]) -> list[np.ndarray]:
        """Hash of the run at each place of each page that has a whole one, mixed with the page's host."""
        sizes = np.array([len(p) for p in pages], dtype=np.int64)
        n = int(sizes.sum()) - self.run + 1
        if n <= 0:
            return [np.zeros(0, dtype=np.int64) for _ in pages]
        codes = np.concatenate(pages)
        h = np.repeat(np.array([self.word(b"host " + x.encode()) for x in hosts], dtype=np.uint64), sizes)[:n]
        for k in range(self.run):
            h += codes[k:k + n] * self.powers[k]
            h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(32))).view(np.int64)
        end = np.cumsum(sizes)
        return [h[a:max(a, b - self.run + 1)] for a, b in zip((end - sizes).tolist(), end.tolist(), strict=True)]


@lru_cache(maxsize=2)
def worker_hashes(run: int) -> _Hashes:
    """One table of word hashes for all tasks that a Python worker runs."""
    return _Hashes(run)


def packed(found: list[str]) -> bytes:
    """Blocks as compressed bytes, one a line (their white space is single spaces); none: empty."""
    return zlib.compress("\n".join(found).encode(), 6) if found else b""


def lines(found: bytes) -> bytes:
    return zlib.decompress(found) if found else b""


def run_pages(pages: list[np.ndarray], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array over distinct pages' codes: a place of each run, and its number of pages.

    Places count whole runs only, page after page, as ``_Hashes.runs`` gives them.
    """
    words, inverse = np.unique(np.concatenate(pages), return_inverse=True)
    sizes = np.array([len(p) for p in pages])
    owner = np.repeat(np.arange(len(pages)), sizes)
    # A mark of its own after each page: no run crosses pages.
    n = len(inverse) + len(pages)
    places = np.arange(len(inverse)) + owner
    rank = np.empty(n, dtype=np.int64)
    rank[places] = inverse
    rank[np.cumsum(sizes + 1) - 1] = len(words) + np.arange(len(pages))
    # Ranks by the first 1, 2, 4, ... run tokens: suffix order, cut off at the run length.
    width = 1
    while width < run:
        step = min(width, run - width)
        after = np.concatenate([rank[step:], np.full(min(step, n), -1)])[:n]
        rank = np.unique(rank * (n + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(inverse))
    whole = left >= run
    rank, page = rank[places][whole], owner[whole]
    suffixes = np.lexsort((page, rank))
    r, p = rank[suffixes], page[suffixes]
    new = np.ones(len(r), dtype=bool)
    new[1:] = r[1:] != r[:-1]
    new_page = new.copy()
    new_page[1:] |= p[1:] != p[:-1]
    starts = np.flatnonzero(new)
    return suffixes[starts], np.add.reduceat(new_page.astype(np.int64), starts) if len(starts) else starts


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [blocks(page or "") for page in batch.column(4).to_pylist()]
        streams = [hashlib.blake2b("\n".join([str(len(h)), h, *f]).encode(), digest_size=8).digest()
                   for h, (f, _) in zip(batch.column(3).to_pylist(), found, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array([packed(f) for f, _ in found], pa.binary()), pa.array([t for _, t in found], pa.bool_()),
             pa.array(np.frombuffer(b"".join(streams), dtype="<i8"), pa.int64())],
            names=["uid", "page_id", "url", "host", "found", "trusted", "stream"])


def _short_runs(run: int, least_pages: int, chunk_pages: int, chunk_chars: int):
    """``bucket, width, gaps``: each page's runs as sorted short hashes, a row for each bucket of a batch."""

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes(run)

        def keys(host: str, held: list[np.ndarray]) -> np.ndarray:
            first, n = run_pages(held, run)
            return np.repeat(np.concatenate(hashes.runs(held, [host] * len(held)))[first], np.minimum(n, least_pages))

        for batch in batches:
            of: dict[str, tuple[list, list]] = {}
            out = []
            for at in range(0, len(batch), 256):
                hosts, found = (batch.slice(at, 256).column(k).to_pylist() for k in range(2))
                texts = [lines(f) for f in found]
                for host, text, codes in zip(hosts, texts, hashes.pages(texts), strict=True):
                    held, chars = of.setdefault(host, ([], []))
                    held.append(codes)
                    chars.append(len(text))
                    if len(held) >= chunk_pages or sum(chars) >= chunk_chars:
                        out.append(keys(host, held))
                        del of[host]
            out += [keys(host, held) for host, (held, _) in of.items()]
            short = np.sort(np.concatenate(out).view(np.uint64) >> np.uint64(64 - _SHORT)) if out else np.zeros(0, dtype=np.uint64)
            bucket = (short >> np.uint64(_SHORT - _BUCKET)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = []
            for one in np.split(short, cuts[1:]) if len(short) else []:
                low = (one & np.uint64((1 << _SHORT - _BUCKET) - 1)).astype("<u4")
                gaps = np.diff(low, prepend=np.uint32(0)).astype("<u4")
                width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
                rows.append((int(one[0]) >> _SHORT - _BUCKET, width, gaps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))],
                names=["bucket", "width", "gaps"])

    return run_


def _suspects(least_pages: int):
    """Rows sorted by bucket: the short hashes that enough pages hold."""

    def many(bucket: int, held: list[np.ndarray]) -> pa.RecordBatch:
        low, n = np.unique(np.concatenate(held), return_counts=True)
        short = (bucket << _SHORT - _BUCKET) + low[n >= least_pages].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(short, pa.int64())], names=["short"])

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for bucket, width, gaps in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if bucket != at:
                    if held:
                        yield many(at, held)
                    at, held = bucket, []
                wide = np.zeros((len(gaps) // width, 4), dtype=np.uint8)
                wide[:, :width] = np.frombuffer(gaps, dtype=np.uint8).reshape(-1, width)
                held.append(np.cumsum(wide.view("<u4").ravel(), dtype=np.uint32))
        if held:
            yield many(at, held)

    return run_


def _page_runs(run: int):
    """``uid, key`` of each distinct run of each page."""

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes(run)
        for batch in batches:
            for at in range(0, len(batch), 64):
                uids, keys = [], []
                of, hosts, found = (batch.slice(at, 64).column(k).to_pylist() for k in range(3))
                for uid, whole in zip(of, hashes.runs(hashes.pages([lines(f) for f in found]), hosts), strict=True):
                    own = np.unique(whole)
                    uids.append(np.full(len(own), uid, dtype=np.int64))
                    keys.append(own)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (uids, keys)], names=["uid", "key"])

    return run_


def clean(found: list[str], trusted: bool, runs: np.ndarray, known: dict[int, int], run: int, least_pages: int) -> str:
    """A page's text without what its host repeats; ``known`` has the host's pages of each repeated run."""
    streams = [b.split(" ") for b in found]
    sizes = np.array([len(b) for b in streams], dtype=np.int64)
    count = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    at_start = np.array([known.get(k, 0) for k in runs.tolist()], dtype=np.int64)
    for k in range(run):  # a token's best covering run
        np.maximum(count[k:k + len(at_start)], at_start, out=count[k:k + len(at_start)])
    word = np.ones(len(count), dtype=bool)
    word[np.cumsum(sizes + 1) - 1] = False
    count, number = count[word], np.repeat(np.arange(len(found)), sizes)
    many = 4 * least_pages
    if trusted:
        gone = np.bincount(number, weights=count >= many, minlength=len(found)) >= sizes
        if sizes[gone].sum() * 2 > sizes.sum():
            gone[:] = False
        return " ".join(b for b, g in zip(found, gone, strict=True) if not g)
    gone = count >= least_pages
    if gone.sum() * 2 > len(gone):
        gone = count >= many
    return " ".join(w for w, g in zip((w for b in streams for w in b), gone, strict=True) if not g)


def _clean(run: int, least_pages: int):
    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_hashes(run)
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, len(whole), 256)):
            texts = []
            hosts, found, trust, repeated = (batch.column(k).to_pylist() for k in range(2, 6))
            found = [lines(f) for f in found]
            codes = hashes.pages([f for f, r in zip(found, repeated, strict=True) if r])
            runs = iter(hashes.runs(codes, [host for host, r in zip(hosts, repeated, strict=True) if r]))
            for f, trusted, rows in zip(found, trust, repeated, strict=True):
                if rows:
                    known = {r["key"]: r["n"] for r in rows}
                    texts.append(clean(f.decode().split("\n"), trusted, next(runs), known, run, least_pages))
                else:
                    texts.append(f.decode().replace("\n", " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return run_


def extract(pages: DataFrame, run: int = 12, least_pages: int = 3, chunk_pages: int = 512, chunk_chars: int = 6_000_000,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars``.

    Null and empty pages have an empty text. A null url is a host of its own; repeated rows are
    each answered. A run counts by the distinct pages of its whole host; chunks bound memory only.
    """
    rows = own_columns(pages, page_id=id_col, url=url_col, html=html_col)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), "url",
                       host.alias("host"), "html")
    parsed = saved(rows.mapInArrow(
        _parsed, "uid long, page_id long, url string, host string, found binary, trusted boolean, stream long"), "pages-parsed")

    def bounded(x: DataFrame) -> DataFrame:
        return F.broadcast(x) if x.count() <= BROADCAST_ROWS else x

    streams = parsed.select("uid", "stream")
    groups = streams.groupBy("stream").agg(F.min("uid").alias("least"), F.count("*").alias("n")).where("n > 1")
    copies = bounded(saved(streams.join(groups, "stream").where("uid <> least").select("uid"), "page-copies"))
    distinct = parsed.where(F.length("found") > 0).select("uid", "host", "found").join(copies, "uid", "left_anti").select("host", "found")
    short = distinct.mapInArrow(_short_runs(run, least_pages, chunk_pages, chunk_chars), "bucket int, width int, gaps binary")
    suspects = saved(short.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_suspects(least_pages), "short long"),
                     "run-suspects")
    of_page = parsed.select("uid", "host", "found").mapInArrow(_page_runs(run), "uid long, key long")
    of_page = saved(of_page.withColumn("short", F.shiftrightunsigned("key", 64 - _SHORT)).join(bounded(suspects), "short", "left_semi")
                    .select("uid", "key"), "page-runs")
    repeated = saved(of_page.join(copies, "uid", "left_anti").groupBy("key").agg(F.count("*").alias("n")).where(
        F.col("n") >= least_pages), "host-runs")
    of_page = of_page.join(bounded(repeated), "key").groupBy(F.col("uid").alias("of")).agg(
        F.collect_list(F.struct("key", "n")).alias("repeated"))
    both = parsed.join(of_page, F.col("uid") == F.col("of"), "left")
    return both.select("page_id", "url", "host", "found", "trusted", "repeated").mapInArrow(
        _clean(run, least_pages), "page_id long, url string, text string, n_chars long")

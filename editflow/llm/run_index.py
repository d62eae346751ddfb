"""Exact removal of repeated byte strings with run-length indexes (run-compressed BWT).

A string of ``length`` bytes is repeated if it starts anywhere else, in any document. To find
all of them without one index over everything:

1. Every start of a ``length``-byte string has an anchor, the least hash of its ``width``-byte
   substrings. Equal strings have equal anchors, and neighbouring starts mostly share one: a
   stretch of starts with one anchor is a segment, about 120 starts long. Segments are counted
   by anchor and by hash of their bytes. A segment whose anchor no other segment has holds no
   repeated string; segments with equal bytes are repeated as a whole.
2. What is left, different segments with a common anchor, is fetched once each and dealt by
   anchor. Each task concatenates the segments of whole anchors up to a bounded size, builds the
   run-compressed Burrows-Wheeler transform of the concatenation and keeps, for the ends of the
   runs, the text position, its neighbour in suffix order and the length they agree. Between
   sampled positions a neighbour moves along with the text, so streaming over the text from one
   sample to the next gives the matching statistics: how long the string at each position is
   found elsewhere. Starts where that reaches ``length`` are repeated.
3. An anchor with very many different segments would be one large task; its strings are
   counted by 128-bit hash instead, which Spark partitions freely.

The repeated spans of a document are then united and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved, text_id
from editflow.llm.shingles import mixed, text_blocks

BROADCAST_ROWS = 400_000  # rows of about 60 bytes: a checked bound; beyond it the join shuffles
_BYTE = np.random.default_rng(23).integers(1, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C13)
# Equal segments have equal anchors too: the two 64-bit hashes together tell their bytes apart.
_SEGMENT = "doc_id long, text_id long, at long, starts int, anchor long, bytes_hash long, inner boolean"


def _substring_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-byte substrings, by doubling."""
    h, size, step = _BYTE[data], 1, _STEP
    total, done, rest = None, 0, width
    while True:
        if rest & 1:
            n = len(data) - done - size + 1
            total = h[:n] if total is None else total[:n] * step + h[done:done + n]
            done += size
        rest >>= 1
        if not rest:
            return mixed(total)
        h = h[:-size] * step + h[size:]
        step = np.uint64(int(step) ** 2 % 2**64)
        size *= 2


def _sliding(values: np.ndarray, places: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over every ``places`` neighbours, by doubling."""
    n, size = len(values) - places + 1, 1
    while size * 2 <= places:
        values = least(values[:-size], values[size:])
        size *= 2
    return least(values[:n], values[places - size:places - size + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, width: int):
    """Segments of texts that stand one after the other: text number, start, starts, anchor, inner.

    ``inner`` tells that the text has the segment's anchor at several places, so that the
    segment may repeat a string within itself.
    """
    n = len(data) - length + 1
    sizes = np.diff(offsets)
    long_enough = np.flatnonzero(sizes >= length)
    if n <= 0 or not len(long_enough):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    places = length - width + 1
    hashes = _substring_hashes(data, width)
    anchor = _sliding(hashes, places, np.minimum)[:n]
    first, end = offsets[long_enough], offsets[long_enough + 1] - length + 1
    inside = np.zeros(n + 1, dtype=np.int64)
    inside[first] += 1
    np.add.at(inside, end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = np.ones(n, dtype=bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[first] = True
    new[end[end < n]] = True
    start = np.flatnonzero(new)
    stop = np.append(start[1:], n)
    ok = inside[start]
    start, stop = start[ok], stop[ok]
    text = np.searchsorted(offsets, start, side="right") - 1
    key = anchor[start]
    # Places that are the anchor of some start: the largest anchor over the starts that see them.
    seen = np.where(inside, anchor, np.uint64(0))
    padded = np.concatenate([np.zeros(places - 1, dtype=np.uint64), seen, np.zeros(len(hashes) - n, dtype=np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, places, np.maximum)[:len(hashes)] == hashes)
    pairs = np.stack([np.searchsorted(offsets, chosen, side="right").astype(np.uint64) - np.uint64(1), hashes[chosen]], 1)
    several = pairs[:0]
    if len(pairs):
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        several = pairs[1:][(pairs[1:] == pairs[:-1]).all(axis=1)]
    inner = np.zeros(len(key), dtype=bool)
    if len(several):
        known = set(map(tuple, several.tolist()))
        inner = np.fromiter(((t, k) in known for t, k in zip(text.tolist(), key.tolist(), strict=True)), bool, len(key))
    return text, start, stop - start, key, inner


def _segment_rows(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tids = batch.column(1).to_numpy()
            row = 0
            for data, offsets in text_blocks(batch.column(2), 1_000_000):
                base = int(offsets[0])
                block, offsets = data[base:int(offsets[-1])], offsets - base
                text, start, starts, key, inner = segments(block, offsets, length, width)
                raw = block.tobytes()
                digests = [xxhash.xxh3_64_intdigest(raw[a:a + m + length - 1])
                           for a, m in zip(start.tolist(), starts.tolist(), strict=True)]
                who = row + text
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(who)),
                     pa.array(tids[who]), pa.array(start - offsets[text]), pa.array(starts.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(np.array(digests, dtype=np.uint64).view(np.int64)), pa.array(inner)],
                    names=["doc_id", "text_id", "at", "starts", "anchor", "bytes_hash", "inner"])
                row += len(offsets) - 1
    return run


class RunIndex:
    """Run-compressed BWT of a text with samples at the ends of its runs.

    Suffixes are ordered by their first ``depth`` bytes, then by position. ``run_heads`` and
    ``run_sizes`` are the transform. ``samples`` (one for each direction) hold the text positions
    where a position's neighbour in suffix order is not the one next to its successor's
    neighbour, which happens at ends of runs only, and how long the two agree there.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.size, self.depth = text, len(text), depth
        levels = self._ranks(text, depth)
        order = np.argsort(levels[-1][1], kind="stable")
        before = text[order - 1]
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.run_heads, self.run_sizes = before[heads], np.diff(np.append(heads, self.size))
        self.samples = []
        for side in (1, -1):
            near = np.full(self.size, -1, dtype=np.int64)  # the neighbour in suffix order
            if side == 1:
                near[order[1:]] = order[:-1]
            else:
                near[order[:-1]] = order[1:]
            sampled = np.ones(self.size, dtype=bool)
            sampled[:-1] = (near[:-1] < 0) | (near[1:] <= 0) | (near[:-1] != near[1:] - 1) | (text[:-1] != text[near[:-1]])
            place = np.flatnonzero(sampled)
            self.samples.append((place, self._agree(levels, place, near[place])))

    @staticmethod
    def _ranks(text: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
        """(width, rank of every position by its first ``width`` bytes) for doubling widths up to depth."""
        symbols = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
        bits = int(symbols.max()).bit_length()
        width = max(1, min(8, 62 // bits, depth))
        padded = np.concatenate([symbols, np.zeros(width, dtype=np.int64)])
        packed = np.zeros(len(text), dtype=np.int64)
        for k in range(width):
            packed = packed << bits | padded[k:k + len(text)]
        rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
        levels = [(width, rank)]
        while width < depth:
            step = min(width, depth - width)
            after = np.zeros(len(text), dtype=np.int64)
            after[:-step] = rank[step:] + 1
            rank = np.unique(rank * (len(text) + 1) + after, return_inverse=True)[1].astype(np.int64)
            width += step
            levels.append((width, rank))
        return levels

    def _agree(self, levels, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at ``a`` and ``b`` have in common, up to the depth (0 for b < 0)."""
        known = b >= 0
        same = np.zeros(len(a), dtype=np.int64)
        x, y = a.copy(), np.where(known, b, 0)
        whole = known & (levels[-1][1][x] == levels[-1][1][y])
        for width, rank in reversed(levels[:-1]):
            inside = known & ~whole & (x < self.size) & (y < self.size)
            equal = np.zeros(len(a), dtype=bool)
            equal[inside] = rank[x[inside]] == rank[y[inside]]
            same += width * equal
            x, y = x + width * equal, y + width * equal
        going = known & ~whole
        for _ in range(levels[0][0] - 1):  # what is left is shorter than the first level
            inside = going & (x < self.size) & (y < self.size)
            going = inside.copy()
            going[inside] = self.text[x[inside]] == self.text[y[inside]]
            same, x, y = same + going, x + going, y + going
        return np.where(whole, self.depth, same)

    def matching_statistics(self) -> np.ndarray:
        """For each position the bytes found elsewhere; below the depth a lower bound."""
        best = np.zeros(self.size, dtype=np.int64)
        for place, agree in self.samples:
            # stream: from a position to the next sample, the match grows by one byte a step
            at = np.searchsorted(place, np.arange(self.size))
            np.maximum(best, agree[at] + place[at] - np.arange(self.size), out=best)
        return best


def _indexed(length: int, chunk_bytes: int):
    """Rows sorted by anchor -> spans (doc_id, text_id, from, to) of repeated strings."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[4] for r in rows]
        joined = b"\x00".join(texts) + b"\x00"  # strings over a mark are no starts
        found = RunIndex(np.frombuffer(joined, dtype=np.uint8), length).matching_statistics() >= length
        out = []
        at = 0
        for doc, tid, place, _, text, single in rows:
            if single:
                hit = found[at:at + len(text) - length + 1]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                out += [(doc, tid, place + a, place + b - 1 + length) for a, b in edge.reshape(-1, 2).tolist()]
            at += len(text) + 1
        return _span_rows(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if held and size >= chunk_bytes and row[3] != held[-1][3]:
                    yield spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield spans(held)

    return run


def _span_rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "text_id", "a", "b"])


def _cut_segments(length: int):
    """(doc_id, text_id, text, wanted) -> one row per wanted segment with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            seen = set()
            for doc, tid, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (doc, tid) in seen:  # repeated rows
                    continue
                seen.add((doc, tid))
                raw = text.encode()
                rows += [(doc, tid, w["at"], w["anchor"], raw[w["at"]:w["at"] + w["starts"] + length - 1], w["single"], w["many"])
                         for w in wanted]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "text_id", "at", "anchor", "bytes", "single", "many"])
    return run


def _string_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tid, at, _, text, single in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                n = len(text) - length + 1
                two = np.frombuffer(b"".join([xxhash.xxh3_128_digest(text[i:i + length]) for i in range(n)]), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([tid] * n, pa.int64()), pa.array(np.arange(at, at + n)),
                     pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array([single] * n, pa.bool_())],
                    names=["doc_id", "text_id", "a", "w1", "w2", "single"])
    return run


def repeated_spans(docs: DataFrame, length: int = 400, width: int | None = None, many: int = 2048,
                   chunk_bytes: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_id, spans``: byte ranges (a, b) that repeated strings cover, possibly overlapping.

    Documents without any have no row. Null texts are empty. Rows that share id and text repeat
    each other; each is a document.
    """
    width = width or max(1, 2 * length // 5)
    rows = _rows(docs, id_col, text_col)
    found = saved(rows.mapInArrow(_segment_rows(length, width), _SEGMENT), "segments")
    # Three quarters of all segments have an anchor of their own; they go before anything else.
    shared = found.groupBy("anchor").agg(F.count("*").alias("total"), F.max("inner").alias("any_inner")).where(
        "total > 1 OR any_inner").select("anchor")
    found = saved(found.join(shared, "anchor"), "shared-segments")
    key = ["anchor", "bytes_hash"]
    kinds = saved(found.groupBy(*key).agg(
        F.count("*").alias("copies"), F.max("inner").alias("inner"),
        F.min(F.struct("doc_id", "text_id", "at", "starts")).alias("first")), "segment-kinds")
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))

    whole = found.join(kinds.where("copies > 1").select(*key), key).select(
        "doc_id", "text_id", F.col("at").alias("a"), (F.col("at") + F.col("starts") - 1 + length).alias("b"))

    wanted = kinds.join(per_anchor, "anchor").where("kinds > 1 OR inner").select(
        "first.doc_id", "first.text_id",
        F.struct("first.at", "first.starts", "anchor", (F.col("copies") == 1).alias("single"),
                 (F.col("kinds") > many).alias("many")).alias("w"))
    wanted = saved(wanted, "wanted-segments")
    by_doc = wanted.groupBy("doc_id", "text_id").agg(F.collect_list("w").alias("wanted")).select(
        F.col("doc_id").alias("w_doc"), F.col("text_id").alias("w_tid"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        by_doc = F.broadcast(by_doc)
    texts = rows.join(by_doc, rows["doc_id"].eqNullSafe(F.col("w_doc")) & (rows["text_id"] == F.col("w_tid")))
    cut = saved(
        texts.select("doc_id", "text_id", "text", "wanted").mapInArrow(
            _cut_segments(length),
            "doc_id long, text_id long, at long, anchor long, bytes binary, single boolean, many boolean"), "segment-bytes")
    dealt = cut.where("not many").drop("many").repartition("anchor").sortWithinPartitions("anchor")
    indexed = dealt.mapInArrow(_indexed(length, chunk_bytes), "doc_id long, text_id long, a long, b long")

    strings = cut.where("many").drop("many").mapInArrow(
        _string_hashes(length), "doc_id long, text_id long, a long, w1 long, w2 long, single boolean")
    again = strings.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hashed = strings.where("single").join(again, ["w1", "w2"]).select(
        "doc_id", "text_id", "a", (F.col("a") + length).alias("b"))

    spans = whole.unionByName(indexed).unionByName(hashed)
    return spans.groupBy("doc_id", "text_id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = own_columns(docs, doc_id=id_col, text=text_col)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), text_id(F.col("text")).alias("text_id"),
                       F.coalesce("text", F.lit("")).alias("text"))


def united(spans: list) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as maximal ones, in order."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, ranges, digest = [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw = text.encode()
            cuts = united(spans)
            ends = [0, *(x for c in cuts for x in c), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            n.append(len(raw))
            gone.append(len(raw) - len(kept))
            ranges.append([{"a": a, "b": b} for a, b in cuts])
            digest.append(hashlib.sha256(kept).hexdigest())
        spans_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(list(map(len, ranges)), pa.int64()), pa.array(digest, pa.string()), pa.array(ranges, spans_type)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes, n_removed, n_spans, kept_sha256`` and the removed ``spans``, united."""
    marks = spans.select(F.col("doc_id").alias("s_doc"), F.col("text_id").alias("s_tid"), "spans")
    rows = _rows(docs, id_col, text_col)
    joined = rows.join(marks, rows["doc_id"].eqNullSafe(F.col("s_doc")) & (rows["text_id"] == F.col("s_tid")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                  "spans array<struct<a:long,b:long>>").withColumnRenamed("doc_id", id_col)

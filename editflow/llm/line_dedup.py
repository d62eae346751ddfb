"""Line dedup: range-partitioned line hashes, streamed in (hash, document, position) order.

Every line whose key (stripped, A-Z lowered) has at least ``min_chars`` code points becomes one
row per document and key: a 128-bit hash, the document and the positions. The rows are range
partitioned and sorted by hash and descending document, so that one pass over a partition meets
the surviving occurrence of each key first and can stream the rest: only the first
``min_docs`` documents of a key are ever held. Document ids are part of the range, so a line
that a third of all documents hold spreads over many partitions. Only the first and the last key of a
partition can continue elsewhere; their rows leave as "open" with a two-row summary per
partition, and the summaries (bounded by twice the partition count) settle them afterwards.

The result is a zlib-compressed keep bitmap per document that loses lines; texts are not
returned. ``apply_bitmaps`` applies them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from editflow.llm.common import ASCII_SPACE, own_columns, saved, text_id

_KEYS = "h1 long, h2 long, doc_id long, text_id long, n_lines int, pos array<int>"
_STREAMED = "kind string, h1 long, h2 long, doc_id long, text_id long, n_lines int, pos array<int>, n_docs long"


def _line_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, docs, ids, counts, places = [], [], [], [], []
            for doc, tid, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                lines = (text or "").split("\n")
                mine: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    if len(line) >= min_chars and len(key := line.strip(ASCII_SPACE)) >= min_chars:
                        # bytes.lower() lowers A-Z only
                        mine.setdefault(xxhash.xxh3_128_digest(key.encode().lower()), []).append(i)
                for digest, pos in mine.items():
                    h.append(digest)
                    docs.append(doc)
                    ids.append(tid)
                    counts.append(len(lines))
                    places.append(pos)
            two = np.frombuffer(b"".join(h), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(docs, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(counts, pa.int32()), pa.array(places, pa.list_(pa.int32()))],
                names=["h1", "h2", "doc_id", "text_id", "n_lines", "pos"],
            )
    return run


def _stream(min_docs: int):
    """Rows to drop of a partition sorted by (hash, doc_id descending), plus what is open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first_key, n_docs, top, last_doc, held = None, True, 0, None, None, []
        out: list[tuple] = []

        def close(last: bool) -> None:
            if first_key or last:
                out.append(("sum", *key, top, None, None, None, n_docs))
            if not first_key and last and n_docs < min_docs:
                out.extend(("open", *key, *row, None) for row in held)
            held.clear()

        for batch in batches:
            for h1, h2, doc, tid, n, pos in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (h1, h2) != key:
                    if key is not None:
                        close(False)
                        first_key = False
                    key, n_docs, top, last_doc = (h1, h2), 0, doc, None
                row = (doc, tid, n, pos)
                if doc != last_doc:
                    n_docs, last_doc = n_docs + 1, doc
                    if n_docs == min_docs and not first_key:
                        out.extend(("drop", *key, *r, None) for r in held if r[0] != top)
                        held.clear()
                if first_key:
                    out.append(("open", *key, *row, None))
                elif n_docs >= min_docs:
                    out.append(("drop", *key, *row, None))
                elif row[:2] not in (r[:2] for r in held):  # repeated rows are one
                    held.append(row)
            if out:
                yield _rows(out)
                out.clear()
        if key is not None:
            close(True)
            yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64()]
    names = ["kind", "h1", "h2", "doc_id", "text_id", "n_lines", "pos", "n_docs"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, tid, n_lines, drops = (batch.column(i).to_pylist() for i in range(4))
        maps, dropped = [], []
        for n, places in zip(n_lines, drops, strict=True):
            keep = np.ones(n, dtype=bool)
            keep[np.concatenate([np.asarray(p, dtype=np.int64) for p in places])] = False
            dropped.append(int(n - keep.sum()))
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(tid, pa.int64()), pa.array(n_lines, pa.int32()),
             pa.array(dropped, pa.int32()), pa.array(maps, pa.binary())],
            names=["doc_id", "text_id", "n_lines", "n_dropped", "keep_bitmap"],
        )


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Compressed keep bitmaps ``(doc_id, text_id, n_lines, n_dropped, keep_bitmap)``.

    One row per document that loses a line; every other document keeps all its lines. A key
    held by at least ``min_docs`` distinct documents stays only in the one with the largest id.
    Null texts are one empty line. Rows with a null id neither vote nor lose lines. Rows that
    share an id count as one document; if their texts differ each has its own bitmap
    (``text_id``).
    """
    rows = own_columns(docs, doc_id=id_col, text=text_col).where("doc_id is not null")
    rows = rows.select(F.col("doc_id").cast("long"), text_id(F.col("text")).alias("text_id"), "text")
    keys = saved(rows.mapInArrow(_line_keys(min_chars), _KEYS), "line-keys")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = saved(ranged.mapInArrow(_stream(min_docs), _STREAMED), "line-stream")

    opened = streamed.where("kind = 'open'").drop("n_docs")
    # Two rows per partition at most, so the broadcast is bounded by the partition count.
    summary = (
        streamed.where("kind = 'sum'").groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("total"), F.max("doc_id").alias("top"))
        .where(f"total >= {int(min_docs)}").select("h1", "h2", "top")
    )
    settled = opened.join(F.broadcast(summary), ["h1", "h2"]).where("doc_id <> top")
    drops = streamed.where("kind = 'drop'").select("doc_id", "text_id", "n_lines", "pos").unionByName(
        settled.select("doc_id", "text_id", "n_lines", "pos"))
    grouped = drops.groupBy("doc_id", "text_id").agg(
        F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("drops")
    ).select("doc_id", "text_id", "n_lines", "drops")
    return grouped.mapInArrow(
        _bitmaps, "doc_id long, text_id long, n_lines int, n_dropped int, keep_bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the kept lines as text, plus ``n_lines`` and ``n_dropped``.

    Documents without a bitmap keep their text as it is (null stays null). The columns of
    ``docs`` keep their names and order; the two counts are added under the names
    ``kept_n_lines`` and ``kept_n_dropped``.
    """
    marks = bitmaps.select(
        F.col("doc_id").alias("__doc"), F.col("text_id").alias("__tid"), F.col("n_dropped").alias("kept_n_dropped"),
        F.col("keep_bitmap").alias("__map"))
    joined = docs.join(
        marks, (docs[id_col].cast("long") == F.col("__doc")) & (text_id(docs[text_col]) == F.col("__tid")), "left"
    ).drop("__doc", "__tid")
    n_lines = (F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"))) + 1).cast("long")
    out = joined.withColumns({
        "kept_n_lines": F.coalesce(n_lines, F.lit(1)),
        "kept_n_dropped": F.coalesce(F.col("kept_n_dropped").cast("long"), F.lit(0)),
    })
    kept = F.when(F.col("__map").isNull(), F.col(text_col)).otherwise(_kept_text(F.col(text_col), F.col("__map")))
    return out.withColumn(text_col, kept).drop("__map")


@F.pandas_udf(StringType())
def _kept_text(text: pd.Series, keep_bitmap: pd.Series) -> pd.Series:
    out = []
    for t, packed in zip(text, keep_bitmap, strict=True):
        if packed is None:
            out.append(None)
            continue
        lines = (t or "").split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), count=len(lines))
        out.append("\n".join(line for line, k in zip(lines, keep, strict=True) if k))
    return pd.Series(out, dtype=object)

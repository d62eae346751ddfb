"""Quality classifier: similarity-weighted votes of labelled latent-semantic vectors.

A text becomes hashed counts of its words, of the shapes of its characters (trigrams over
character classes) and of words that repeat shortly after one another. The counts of a bounded
sample of labelled rows are weighted by inverse document frequency and reduced by a truncated
singular value decomposition; the sample's vectors and the projection are the whole model. It
is broadcast: its size is fixed by ``per_class``, ``N_FEATURES`` and ``rank``. Every document
is then projected and compared with all labelled vectors by blocked matrix products, and its
nearest neighbours vote with their cosine. Only the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructType

from editflow.llm.common import own_columns

_WORDS, _SHAPES, _REPEATS = 768, 1248, 32
N_FEATURES = _WORDS + _SHAPES + _REPEATS
_BLOCK_BYTES, _BLOCK_ROWS = 2_000_000, 512
_PART_BYTES = 250_000  # of texts counted at once: some seventy bytes of work space for each of theirs

# Character classes: 0 other control, 1 space, 2 line break, 3 lower, 4 upper, 5 digit,
# 6 first byte and 7 later byte of a non-ASCII character, then one for each ASCII punctuation mark.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[[9, 11, 12, 13, 32]] = 1
_CLASS[10] = 2
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 3, 4, 5
_CLASS[192:256], _CLASS[128:192] = 6, 7
_PUNCTUATION = [c for c in range(33, 127) if _CLASS[c] == 0]
_CLASS[_PUNCTUATION] = np.arange(8, 8 + len(_PUNCTUATION))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.random.default_rng(6).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _bins(codes: np.ndarray, n: int) -> np.ndarray:
    return ((codes.astype(np.uint64) * _MIX) >> np.uint64(33)).astype(np.int64) % n


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashed counts (texts by ``N_FEATURES``) of texts that stand one after the other as UTF-8.

    They are counted some at a time. Empty texts go with the one before them.
    """
    out, at = np.zeros((len(offsets) - 1, N_FEATURES), dtype=np.float32), 0
    while at < len(out):
        to = int(np.searchsorted(offsets, offsets[at] + _PART_BYTES, side="right")) - 1
        to = int(np.searchsorted(offsets, offsets[max(to, at + 1)], side="right")) - 1
        out[at:to] = _part_counts(data, offsets[at:to + 1])
        at = to
    return out


def _part_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    data = data[offsets[0]:offsets[-1]]
    offsets = offsets.astype(np.int64) - int(offsets[0])
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    if not len(data):
        return out
    doc = np.repeat(np.arange(n), np.diff(offsets))

    cls = _CLASS[data]
    ends = np.ones(len(data), dtype=bool)  # no trigram across two texts
    ends[np.maximum(offsets[1:] - 1, 0)] = False
    ends[np.maximum(offsets[1:] - 2, 0)] = False
    code = (cls[:-2] * 64 + cls[1:-1]) * 64 + cls[2:]
    inside = ends[:-2]
    flat = doc[:-2][inside] * _SHAPES + _bins(code[inside], _SHAPES)
    out[:, _WORDS:_WORDS + _SHAPES] = np.bincount(flat, minlength=n * _SHAPES).reshape(n, _SHAPES)

    solid = (cls != 1) & (cls != 2)
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    starts[first] = solid[first]
    at = np.flatnonzero(starts)
    if len(at):
        place = np.arange(len(data)) - np.repeat(at, np.diff(np.append(at, len(data)))) if at[0] == 0 else None
        if place is None:
            lead = np.arange(len(data))
            place = lead - at[np.maximum(np.searchsorted(at, lead, side="right") - 1, 0)]
        value = np.where(solid, _BYTE[data] * _PLACE[np.maximum(place, 0) % 64], np.uint64(0))
        words = np.add.reduceat(value, at)
        word_doc = doc[at]
        out[:, :_WORDS] = np.bincount(
            word_doc * _WORDS + _bins(words, _WORDS), minlength=n * _WORDS).reshape(n, _WORDS)
        for back in (1, 2, 3, 4):
            same = (words[back:] == words[:-back]) & (word_doc[back:] == word_doc[:-back])
            found = np.bincount(word_doc[back:][same], minlength=n)
            total = np.maximum(np.bincount(word_doc, minlength=n), 1)
            # a share in eighths, as a one-hot feature that weighs like a frequent one
            level = np.minimum(found * 8 // total, 7)
            hit = found * 8 >= total
            out[np.flatnonzero(hit), _WORDS + _SHAPES + (back - 1) * 8 + level[hit]] = 64
    return out


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte and offset views of a string column in blocks of bounded size (nulls are empty)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + _BLOCK_BYTES, side="right")) - 1
        to = min(max(to, at + 1), at + _BLOCK_ROWS, len(column))
        yield data, offsets[at:to + 1]
        at = to


class Model:
    """Weights, projection, and the unit vectors and labels of the sample."""

    def __init__(self, weights: np.ndarray, basis: np.ndarray, vectors: np.ndarray, labels: np.ndarray, prior: float,
                 neighbours: int):
        self.weights, self.basis, self.vectors, self.labels = weights, basis, vectors, labels
        self.prior, self.neighbours = prior, neighbours

    def project(self, raw: np.ndarray) -> np.ndarray:
        x = (np.log1p(raw) * self.weights) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def vote(self, raw: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors; the prior where nothing is similar."""
        if not len(self.labels):
            return np.full(len(raw), self.prior)
        cosine = self.project(raw) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 8
        total = weight.sum(axis=1)
        share = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-6, share, self.prior), 0.0, 1.0)


def train(raw: np.ndarray, labels: np.ndarray, prior: float, rank: int = 64, neighbours: int = 25) -> Model:
    """Truncated decomposition of the weighted counts (subspace iteration from a seeded start)."""
    if not len(labels):
        empty = np.zeros((N_FEATURES, 1), dtype=np.float32)
        return Model(np.zeros(N_FEATURES, dtype=np.float32), empty, np.zeros((0, 1), dtype=np.float32), labels, prior, 1)
    weights = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    x = np.log1p(raw) * weights
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rank = min(rank, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], rank)).astype(np.float32)
    for _ in range(8):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    model = Model(weights, q.astype(np.float32), np.zeros((0, rank)), labels, prior, neighbours)
    model.vectors = model.project(raw).astype(np.float32)
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def clipped(raw: np.ndarray) -> np.ndarray:
    """Counts as fitting and scoring both see them: at most what two bytes hold."""
    return np.minimum(raw, 65535)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [clipped(counts(d, o)) for d, o in _blocks(batch.column(0))]
        flat = np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), dtype=np.float32)
        packed = [r.astype("<u2").tobytes() for r in flat]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], names=["raw", "label"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1024, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rank: int = 64, neighbours: int = 25) -> Model:
    """Fit on at most ``per_class`` labelled rows of each class, chosen by a hash of the id.

    Rows of the held-out fold, null labels and labels without a document are not used. An id that is
    labelled several times counts once, with its least label; of documents that share an id the least
    text (in code-point order) is taken. So one row for each chosen id reaches the driver.
    """
    marks = own_columns(labels, id=id_col, label=label_col)
    marks = marks.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    marks = marks.groupBy("id").agg(F.min("label").alias("label"))
    share = marks.agg(F.avg(F.col("label").cast("double"))).first()[0]
    order = F.md5(F.concat(F.lit("quality|"), F.col("id").cast("string")))
    chosen = marks.where("label = 0").orderBy(order, "id").limit(per_class).unionByName(
        marks.where("label = 1").orderBy(order, "id").limit(per_class))
    rows = own_columns(docs, doc=id_col, text=text_col)
    # The limits above bound the broadcast.
    sample = rows.join(F.broadcast(chosen), F.col("doc") == F.col("id")).groupBy("id").agg(
        F.min("text").alias("text"), F.min(F.col("label").cast("int")).alias("label")).select("text", "label")
    got = sample.mapInArrow(_count_rows, "raw binary, label int").collect()
    got = sorted((bytes(r["raw"]), r["label"]) for r in got)  # equal inputs come in any order
    raw = np.array([np.frombuffer(r, dtype="<u2") for r, _ in got], dtype=np.float32).reshape(-1, N_FEATURES)
    return train(raw, np.array([y for _, y in got], dtype=np.int64), 0.5 if share is None else float(share), rank, neighbours)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` plus ``quality_score`` (0 to 1). Texts without any feature get the labels' average.

    Without ``keep_text`` the text itself isn't sent back from the workers. A column that is called
    ``quality_score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for batch in batches:
            parts = [m.vote(clipped(counts(d, o))) for d, o in _blocks(batch.column(0))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], schema=out)

    rest = [c for c in docs.columns if (keep_text or c != text_col) and c != "quality_score"]
    rows = docs.select(F.col(text_col).alias("__text"), *rest)
    schema = StructType(rows.schema.fields[1:]).add("quality_score", DoubleType())
    out = to_arrow_schema(schema)
    return rows.mapInArrow(run, schema)

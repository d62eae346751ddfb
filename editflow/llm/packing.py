"""Best-fit packing by a grouping genetic algorithm on islands.

Texts become pieces of at most ``capacity`` tokens. Full pieces are sequences of their own; the
others are dealt at random into shards of about ``shard_items`` pieces. A shard is one row, and
several islands evolve it separately: a population of packings, where crossover injects whole
well-filled bins of one parent into the other, removes the bins that hold an injected piece
twice, and best-fits the displaced pieces. Between epochs every island sends its elite to the
next island of its shard (a join on shard and island). The best packing of a shard is unpacked;
pieces of bins that stayed loose are dealt into new shards with those of all other shards and
packed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved
from editflow.llm.tokens import worker_encoder

_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(ranks_path: str, pattern: str, capacity: int, end_id: int, specials: dict[str, int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ranks_path, pattern, tuple(sorted((specials or {}).items())))
        uid = TaskContext.get().partitionId() << 36
        end = np.asarray([end_id], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            rows = []
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(docs), 2048):
                for doc, ids in zip(docs[at:at + 2048], encoder.encode([t or "" for t in texts[at:at + 2048]]), strict=True):
                    ids += end
                    first = len(ids) % width or width
                    cuts = [0, *range(first, len(ids) + 1, width)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append((uid, doc, k, a // 4, (b - a) // 4, zlib.crc32(ids[a:b])))
                        uid += 1
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(columns)],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = 2048, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text", specials: dict[str, int] | None = None) -> DataFrame:
    """Token pieces of every row: ``uid, doc_id, piece, start, length, ids_crc32``.

    A text's ids are followed by ``end_id``; null is the empty text (one token). Only longer
    texts are cut, into full pieces but for the first. ``uid`` tells rows apart, repeated ones too.
    ``specials`` are strings with an id of their own; without it all text is ordinary.
    """
    rows = own_columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_cut(ranks_path, pattern, capacity, end_id, specials), _PIECES)


class _Bins:
    """Best fit by remaining room: a bit per room value that has an open bin."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.mask = capacity, [[] for _ in range(capacity + 1)], 0
        self.bins: list[list[int]] = []

    def open(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self._list(len(self.bins) - 1, room)

    def _list(self, b: int, room: int) -> None:
        if room:
            self.rooms[room].append(b)
            self.mask |= 1 << room

    def add(self, item: int, size: int) -> None:
        fitting = self.mask >> size
        if not fitting:
            self.open([item], self.capacity - size)
            return
        room = size + (fitting & -fitting).bit_length() - 1
        b = self.rooms[room].pop()
        if not self.rooms[room]:
            self.mask ^= 1 << room
        self.bins[b].append(item)
        self._list(b, room - size)


def _best_fit(order, sizes, capacity: int) -> list[list[int]]:
    bins = _Bins(capacity)
    for i in order:
        bins.add(i, sizes[i])
    return bins.bins


def _score(bins: list[list[int]], sizes, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (sum of squared fills)."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _crossover(a: list[list[int]], b: list[list[int]], sizes, capacity: int, rng) -> list[list[int]]:
    full = [x for x in b if sum(sizes[i] for i in x) >= capacity - 2]
    take = full if len(full) < 2 else [full[k] for k in rng.choice(len(full), max(1, len(full) // 2), replace=False)]
    injected = {i for x in take for i in x}
    out = _Bins(capacity)
    displaced: list[int] = []
    for x in a:
        if injected.isdisjoint(x):
            # loose bins dissolve now and then, so that their pieces meet other gaps
            room = capacity - sum(sizes[i] for i in x)
            if room > 2 and rng.random() < 0.3:
                displaced.extend(x)
            else:
                out.open(list(x), room)
        else:
            displaced.extend(i for i in x if i not in injected)
    for x in take:
        out.open(list(x), capacity - sum(sizes[i] for i in x))
    displaced.sort(key=lambda i: -sizes[i])
    for i in displaced:
        out.add(i, sizes[i])
    return out.bins


def _flat(bins: list[list[int]], n: int) -> list[int]:
    of = [0] * n
    for k, x in enumerate(bins):
        for i in x:
            of[i] = k
    return of


def _grouped(of: list[int]) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(of):
        out.setdefault(k, []).append(i)
    return list(out.values())


def evolve(sizes: list[int], capacity: int, seed: int, given: list[list[list[int]]],
           population: int = 3, generations: int = 4) -> list[list[list[int]]]:
    """Best packings first. ``given`` are packings to start from (own ones and immigrants)."""
    rng = np.random.default_rng(seed)
    n = len(sizes)
    people = list(given)
    decreasing = sorted(range(n), key=lambda i: -sizes[i])
    if not people:
        people.append(_best_fit(decreasing, sizes, capacity))
    least = -(-sum(sizes) // capacity)
    while len(people) < population:
        noise = rng.normal(0, capacity / 16, n)
        people.append(_best_fit(sorted(range(n), key=lambda i: noise[i] - sizes[i]), sizes, capacity))
    scored = sorted(((_score(p, sizes, capacity), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])[:population]
    born = len(people)
    for _ in range(generations * population):
        if scored[0][0][0] <= least:
            break
        i, j = rng.choice(len(scored), 2, replace=False)
        child = _crossover(scored[i][2], scored[j][2], sizes, capacity, rng)
        born += 1
        scored = sorted([*scored, (_score(child, sizes, capacity), born, child)], key=lambda x: x[:2])[:population]
    return [p for _, _, p in scored]


def _island(capacity: int, seed: int, elites: int):
    """Rows (shard, island, sizes, own, came) -> (shard, island, own, n_bins); packings as flat bin numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                given = [_grouped(x) for x in (row["own"] or []) + (row["came"] or [])]
                best = evolve(row["sizes"], capacity, seed + 7919 * row["shard"] + row["island"] + len(given), given)
                n = len(row["sizes"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int64()), pa.array([row["island"]], pa.int32()),
                     pa.array([[_flat(p, n) for p in best[:elites]]], pa.list_(pa.list_(pa.int32()))),
                     pa.array([len(best[0])], pa.int32())],
                    names=["shard", "island", "own", "n_bins"])
    return run


def _unpack(capacity: int, base: int):
    names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fill: dict[int, int] = {}
                offsets = []
                for x, b in zip(row["items"], row["best"], strict=True):
                    offsets.append(fill.get(b, 0))
                    fill[b] = offsets[-1] + x["length"]
                cols = [pa.array([x[c] for x in row["items"]], pa.int32() if c == "piece" else pa.int64()) for c in names]
                cols.append(pa.array([base + (row["shard"] << 20) + b for b in row["best"]], pa.int64()))
                cols.append(pa.array(offsets, pa.int64()))
                cols.append(pa.array([fill[b] for b in row["best"]], pa.int64()))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset", "fill"])
    return run


def _packed(items: DataFrame, capacity: int, shard_items: int, islands: int, epochs: int, seed: int,
            base: int) -> DataFrame:
    """Pieces plus ``sequence_id, offset, fill``; one pass over random shards."""
    n_shards = max(1, -(-items.count() // shard_items))
    shard = F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(n_shards)).alias("shard")
    columns = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
    # A shard holds about shard_items pieces whatever repeats in the data: uids are dealt, not keys.
    shards = saved(
        items.select(shard, F.struct(*columns).alias("item")).groupBy("shard").agg(
            F.array_sort(F.collect_list("item")).alias("items")), "pack-shards")
    sizes = shards.select("shard", F.col("items.length").alias("sizes"))
    none = F.lit(None).cast("array<array<int>>")
    state = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = state.withColumns({"own": none, "came": none})
    for epoch in range(epochs):
        ran = saved(
            state.select("shard", "island", "sizes", "own", "came").repartition("shard", "island")
            .mapInArrow(_island(capacity, seed + 104_729 * epoch, 2),
                        "shard long, island int, own array<array<int>>, n_bins int"), "pack-islands")
        if epoch + 1 == epochs:
            break
        elite = ran.select("shard", F.expr(f"(island + 1) % {islands}").alias("island"), F.slice("own", 1, 1).alias("came"))
        state = ran.drop("n_bins").join(elite, ["shard", "island"]).join(sizes, "shard")
    best = ran.groupBy("shard").agg(F.min_by(F.get("own", F.lit(0)), F.struct("n_bins", "island")).alias("best"))
    return shards.join(best, "shard").select("shard", "items", "best").mapInArrow(
        _unpack(capacity, base), _PIECES + ", sequence_id long, offset long, fill long")


def pack(cut: DataFrame, capacity: int = 2048, shard_items: int = 4096, islands: int = 2, epochs: int = 2,
         seed: int = 1, loose: float = 0.995) -> DataFrame:
    """Every piece of ``cut`` (a written table of ``pieces``) with ``sequence_id`` and ``offset``.

    Sequences hold at most ``capacity`` tokens without gaps. An empty table gives no rows.
    """
    full = cut.where(F.col("length") == capacity).withColumns({
        "sequence_id": F.lit(1 << 61) + F.col("uid"), "offset": F.lit(0).cast("long")})
    first = saved(_packed(cut.where(F.col("length") < capacity), capacity, shard_items, islands, epochs, seed, 0), "packed")
    tight = F.col("fill") >= int(loose * capacity)
    again = _packed(first.where(~tight).drop("sequence_id", "offset", "fill"), capacity, shard_items, islands, epochs,
                    seed + 1, 1 << 60)
    return full.unionByName(first.where(tight).drop("fill")).unionByName(again.drop("fill"))

"""Embedding near-dedup by NN-descent on threshold edges.

Equal vectors of a label are one node. The neighbour graph starts from a few orders by random
hyperplane signature (range partitioned, so a label of any size is spread) and is refined: each
node's list and a bounded part of its reverse list meet with their vectors in one place, where
neighbours of a neighbour are compared; every node keeps its best ``k``. Edges at or above the
threshold are links.

A list whose last entry is a link is saturated: there may be more, in and outside the component
that the lists form. Every node of a component with a saturated list is therefore searched
exactly among all vectors of its label, in blocks: links are counted and joined to spanning
edges, never written out as pairs. Cells around pivots leave out vectors that are provably too far.

Recall is audited by the same exact search for a sample over labels and group sizes that must
hold enough true links, and judged by link, by vector and by group size; below the target the
refinement goes on with lists twice as long, and after the last turn, or where the sample shows
too few links to judge, every node is searched exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved
from editflow.llm.components import components

SAMPLES = (4_096, 16_384)  # audited nodes, and how many if those show too few links
_LEAST_LINKED = 100  # audited nodes with links that a verdict needs
_LEAST_GROUP = 20  # the same for nodes of one group size
_HOMES, _STRIP, _STEP = 2_048, 8_192, 1_024  # vectors a task holds, meets, and compares at once
_CELL, _PIVOTS_OF_PART, _PIVOTS = 8_192, 64, 4_096


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows of length one, zero rows as they are; first divided by their largest component, so that neither
    squares nor sums of very large or very small ones leave the range of a double."""
    peak = np.abs(x).max(axis=1, keepdims=True) if x.size else np.ones((len(x), 1))
    x = x / np.where(peak > 0, peak, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _unit(vectors: list, as_type=np.float64) -> np.ndarray:
    return _scaled(np.array(vectors, dtype=np.float64)).astype(as_type)


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _scaled(flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1)))


def nodes(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` -> one row per distinct usable vector: ``node, part, vec, copies, least``."""
    return vectors.where("node is not null").groupBy("node").agg(
        F.first("part").alias("part"), F.first("embedding").alias("vec"), F.count("*").alias("copies"),
        F.min("vec_id").alias("least"))


def _usable(vectors: DataFrame) -> DataFrame:
    """Adds ``part`` (label and length) and ``node`` (null where the vector links with nothing)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0)
    part = F.struct(F.col("label"), F.size(x).alias("size"))
    return vectors.withColumns({"part": part, "node": F.when(usable, F.xxhash64("label", "embedding"))})


def _signatures(tables: int, bits: int, seed: int):
    """A row for each vector and table; planes are drawn once for each length, signs are one product."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits - 1, -1, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                if size not in planes:
                    planes[size] = np.random.default_rng(seed + size).standard_normal((tables * bits, size))
                rows = np.flatnonzero(sizes == size)
                for k in range(0, len(rows), _STEP):
                    one = [batch.column(c).take(pa.array(rows[k:k + _STEP])) for c in range(3)]
                    signs = (_matrix(one[2]) @ planes[size].T > 0).reshape(-1, tables, bits).astype(np.int64)
                    again = pa.array(np.repeat(np.arange(len(signs)), tables))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(signs))), pa.array((signs @ weights).ravel())]
                        + [c.take(again) for c in one], names=["turn", "signature", "node", "part", "vec"])
    return run


def _near_in_order(width: int):
    """Rows sorted by (turn, part, signature): cosines of each row with the ``width`` next ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            a, b, s = [], [], []
            for turn, node, part, vec in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                key = (turn, part["label"], part["size"])
                x = _unit([vec])[0]
                held = [h for h in held[-width:] if h[0] == key]
                for _, other, y in held:
                    if other != node:
                        a += [node, other]
                        b += [other, node]
                        s += [float(x @ y)] * 2
                held.append((key, node, x))
            yield _edges(a, b, s)
    return run


def _edges(a, b, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())],
                                      names=["node", "near", "cosine"])


_EDGE = "node long, near long, cosine double"


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best entries of each list; Spark limits each group before it shuffles."""
    order = Window.partitionBy("node").orderBy(F.col("cosine").desc(), "near")
    once = edges.groupBy("node", "near").agg(F.max("cosine").alias("cosine"))
    return once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def _meet(k: int):
    """Rows sorted by ``at`` with their vectors: every member's best neighbours among the members."""

    def group(ids: list[int], vecs: list) -> tuple[list, list, list]:
        x = _unit(vecs)
        cosine = x @ x.T
        np.fill_diagonal(cosine, -2)
        n = min(k, len(ids) - 1)
        near = np.argpartition(-cosine, n - 1, axis=1)[:, :n] if n < len(ids) - 1 else np.argsort(-cosine, axis=1)[:, :n]
        who = np.asarray(ids)
        return np.repeat(who, n).tolist(), who[near].ravel().tolist(), np.take_along_axis(cosine, near, 1).ravel().tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, vecs = None, [], []
        for batch in batches:
            a, b, s = [], [], []
            for place, member, vec in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
                if place != at:
                    if len(ids) > 1:
                        for out, new in zip((a, b, s), group(ids, vecs), strict=True):
                            out += new
                    at, ids, vecs = place, [], []
                ids.append(member)
                vecs.append(vec)
            yield _edges(a, b, s)
        if len(ids) > 1:
            yield _edges(*group(ids, vecs))

    return run


def _refined(graph: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    back = graph.select(F.col("near").alias("node"), F.col("node").alias("near"), "cosine")
    members = graph.select(F.col("node").alias("at"), F.col("near").alias("member")).unionByName(
        _best(back, k).select(F.col("node").alias("at"), F.col("near").alias("member"))).unionByName(
        vectors.select(F.col("node").alias("at"), F.col("node").alias("member"))).distinct()
    met = members.join(vectors.select(F.col("node").alias("member"), "vec"), "member").select("at", "member", "vec")
    met = met.repartition("at").sortWithinPartitions("at")
    return saved(_best(graph.unionByName(met.mapInArrow(_meet(k), _EDGE)), k), "neighbours")


def _start(vectors: DataFrame, k: int, tables: int, seed: int) -> DataFrame:
    rows = vectors.select("node", "part", "vec")
    label = rows.schema["part"].dataType["label"].dataType.simpleString()
    signed = rows.mapInArrow(
        _signatures(tables, 40, seed),
        f"turn int, signature long, node long, part struct<label:{label},size:int>, vec {rows.schema['vec'].dataType.simpleString()}")
    order = ["turn", "part", "signature", "node"]
    ranged = signed.repartitionByRange(*order).sortWithinPartitions(*order)
    near = ranged.select("turn", "node", "part", "vec").mapInArrow(_near_in_order(k), _EDGE)
    return saved(_best(near, k), "neighbours")


class _Homes:
    """Searched nodes of one block: link counts by copies, and their components by smallest place."""

    def __init__(self):
        self.ids, self.vecs, self.copies, self.x = [], [], [], None

    def add(self, rows: pa.RecordBatch) -> None:
        self.ids.append(rows.column(0).to_numpy())
        self.vecs.append(_matrix(rows.column(1)))
        self.copies.append(rows.column(2).to_numpy())

    def _ready(self) -> None:
        if self.x is None:
            self.x, self.node, self.weight = map(np.concatenate, (self.vecs, self.ids, self.copies))
            self.linked, self.place = np.zeros(len(self.node), dtype=np.int64), np.arange(len(self.node))

    def meet(self, rows: pa.RecordBatch, threshold: float) -> pa.RecordBatch:
        """Counts and an edge for each linked visitor that isn't searched itself."""
        self._ready()
        other, weight = rows.column(0).to_numpy(), rows.column(2).to_numpy()
        found = (self.x @ _matrix(rows.column(1)).T >= threshold) & (self.node[:, None] != other)
        self.linked += found @ weight
        mine, theirs = np.flatnonzero(found.any(1)), np.flatnonzero(found.any(0))
        if not len(mine):
            return _searched_rows([], [], [])
        part = found[np.ix_(mine, theirs)]
        while True:
            least = np.where(part, self.place[mine][:, None], len(self.node)).min(0)
            to = np.arange(len(self.node))
            np.minimum.at(to, self.place[mine], np.where(part, least, len(self.node)).min(1))
            place = to[self.place]
            if (place == self.place).all():
                break
            self.place = place
        counts = np.where(rows.column(3).to_numpy(zero_copy_only=False)[theirs], 0, self.weight[mine] @ part)
        return _searched_rows(other[theirs], counts, self.node[mine[part.argmax(0)]])

    def done(self) -> pa.RecordBatch:
        self._ready()
        return _searched_rows(self.node, self.linked, self.node[self.place])


def _searched_rows(node, linked, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, linked, near)], names=["node", "linked", "near"])


def _search(threshold: float):
    """Rows sorted by block, its searched nodes first: ``node, linked, near``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, homes = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(5, 10)), strict=True))
            start = 0
            for stop in range(1, len(keys) + 1):
                if stop < len(keys) and keys[stop] == keys[start]:
                    continue
                if keys[start] != at:
                    if homes:
                        yield homes.done()
                    at, homes = keys[start], _Homes()
                rows = batch.slice(start, stop - start)
                held = int(np.sum(rows.column(4).to_numpy(zero_copy_only=False)))
                if held:
                    homes.add(rows.slice(0, held))
                for k in range(held, len(rows), _STEP):
                    yield homes.meet(rows.slice(k, min(_STEP, len(rows) - k)), threshold)
                start = stop
        if homes:
            yield homes.done()

    return run


def _to_cells(pivots: dict[tuple, np.ndarray], threshold: float):
    """A searched node goes to its nearest pivot's cell, every vector to all cells that can link with it.

    For a node h nearest to pivot c and a vector v within the chord of the threshold,
    v (p_b - p_c) <= (h - v) (p_c - p_b) <= chord * |p_c - p_b| for every pivot b.
    """
    chord = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    gaps = {key: chord * np.linalg.norm(p[:, None] - p[None], axis=2) + 1e-9 for key, p in pivots.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[tuple, list[int]] = {}
            for k, p in enumerate(batch.column(1).to_pylist()):
                by.setdefault((p["label"], p["size"]), []).append(k)
            searched = batch.column(4).to_numpy(zero_copy_only=False)
            for key, where in by.items():
                places = np.asarray(where)
                if key in pivots:
                    near = _matrix(batch.column(2).take(pa.array(places))) @ pivots[key].T
                    need = np.ones(near.shape, dtype=bool)
                    for b in range(near.shape[1]):
                        need &= near[:, b:b + 1] - near <= gaps[key][:, b]
                    own = near.argmax(1)
                else:
                    need, own = np.ones((len(places), 1), dtype=bool), np.zeros(len(places), dtype=np.int64)
                visitor, cell = np.nonzero(need)
                home = np.flatnonzero(searched[places])
                held = np.repeat([True, False], [len(home), len(visitor)])
                rows = batch.take(pa.array(places[np.concatenate([home, visitor])]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(held), pa.array(np.concatenate([own[home], cell]), pa.int32())],
                    names=["node", "part", "vec", "copies", "searched", "held", "cell"])

    return run


def _pivots(vectors: DataFrame, cell: int) -> dict[tuple, np.ndarray]:
    """A few vectors of each part that is larger than a cell; at most ``_PIVOTS`` in all."""
    large = vectors.groupBy("part").agg(F.count("*").alias("size")).where(F.col("size") > cell)
    order = Window.partitionBy("part").orderBy(F.xxhash64(F.lit("pivot"), "node"))
    wanted = F.least(F.ceil(F.col("size") / cell), F.lit(_PIVOTS_OF_PART))
    first = vectors.select("node", "part").withColumn("r", F.row_number().over(order)).where(F.col("r") <= _PIVOTS_OF_PART)
    few = first.join(large, "part").where(F.col("r") <= wanted).orderBy("r", "node").limit(_PIVOTS).select("node")
    by: dict[tuple, list] = {}
    for r in vectors.join(few, "node").select("part", "vec").collect():
        by.setdefault((r["part"]["label"], r["part"]["size"]), []).append(r["vec"])
    return {key: _unit(vecs) for key, vecs in by.items()}


def _exact(homes: DataFrame, vectors: DataFrame, threshold: float, cell: int = _CELL) -> DataFrame:
    """Every link of the nodes in ``homes`` with any vector of their part: ``node, linked, near``.

    ``linked`` adds up to a home's links, and to the links that another node has with homes;
    ``near`` are edges that join what these links join.
    """
    rows = vectors.join(homes.select("node").withColumn("searched", F.lit(True)), "node", "left").select(
        "node", "part", "vec", "copies", F.coalesce("searched", F.lit(False)).alias("searched"))
    of = {f.name: f.dataType.simpleString() for f in rows.schema}
    dealt = rows.mapInArrow(
        _to_cells(_pivots(vectors, cell), threshold),
        f"node long, part {of['part']}, vec {of['vec']}, copies long, searched boolean, held boolean, cell int")
    blocks = dealt.groupBy("part", "cell").agg(
        F.sum(F.col("held").cast("long")).alias("n_held"), F.sum((~F.col("held")).cast("long")).alias("n_met")).where("n_held > 0")
    blocks = blocks.select("part", "cell", F.ceil(F.col("n_held") / _HOMES).cast("int").alias("subs"),
                           F.ceil(F.col("n_met") / _STRIP).cast("int").alias("strips"))
    x = dealt.join(blocks, ["part", "cell"])
    own = F.pmod(F.xxhash64("node"), F.when(F.col("held"), F.col("subs")).otherwise(F.col("strips"))).cast("int")
    x = x.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.when(F.col("held"), F.col("strips")).otherwise(F.col("subs")) - 1)))
    key = ["label", "size", "cell", "sub", "strip"]
    x = x.select("node", "vec", "copies", "searched", "held", F.col("part.label").alias("label"), F.col("part.size").alias("size"),
                 "cell", F.when(F.col("held"), F.col("own")).otherwise(F.col("other")).alias("sub"),
                 F.when(F.col("held"), F.col("other")).otherwise(F.col("own")).alias("strip"))
    together = x.repartition(*key).sortWithinPartitions(*key, F.col("held").desc())
    return saved(together.mapInArrow(_search(threshold), "node long, linked long, near long"), "searched")


def _sums(searched: DataFrame) -> DataFrame:
    return searched.groupBy("node").agg(F.sum("linked").alias("linked")).where("linked > 0")


def _edges_of(searched: DataFrame) -> DataFrame:
    return searched.where("node <> near").select(F.col("node").alias("a"), F.col("near").alias("b")).distinct()


def _audit(vectors: DataFrame, counted: DataFrame, threshold: float) -> float | None:
    """Found share of true links: the least by link, by vector and by group size; None if too few were seen."""
    found = vectors.select("node", "part").join(counted, "node", "left").select(
        "node", "part", F.coalesce("linked", F.lit(0)).alias("linked"))
    group = F.floor(F.log2(F.col("linked") + 1))
    order = Window.partitionBy("part", group).orderBy(F.xxhash64(F.lit("audit"), "node"))
    ranked = found.withColumn("r", F.row_number().over(order))
    total = vectors.count()
    for size in SAMPLES:
        # Every label and group size in turn; ties by hash, so no label comes first.
        sample = saved(ranked.where(F.col("r") <= size).orderBy("r", F.xxhash64("node")).limit(size).select("node", "linked"), "audited")
        truth = _sums(_exact(sample, vectors, threshold)).withColumnRenamed("linked", "truth")
        both = sample.join(truth, "node").withColumn("hit", F.least("linked", "truth"))
        by = both.groupBy(F.floor(F.log2("truth")).alias("g")).agg(
            F.count("*").alias("n"), F.sum("truth").alias("truth"), F.sum("hit").alias("hit"),
            F.sum(F.col("hit") / F.col("truth")).alias("shares")).collect()  # a row for each power of two
        n = sum(r["n"] for r in by)
        if n >= _LEAST_LINKED or size >= total:
            judged = [sum(r["hit"] for r in by) / sum(r["truth"] for r in by), sum(r["shares"] for r in by) / n] if n else [1.0]
            return min(judged + [r["shares"] / r["n"] for r in by if r["n"] >= _LEAST_GROUP])
    return None


def near_duplicates(table: DataFrame, threshold: float = 0.98, k: int = 6, tables: int = 4, rounds: int = 3,
                    target: float = 0.95, max_turns: int = 3, seed: int = 17,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept`` and the audited ``recall``.

    Vectors with equal, non-null labels link from cosine ``threshold`` on (double precision).
    Null, empty and zero vectors, null or non-finite components, null labels and null ids link
    with nothing; vectors of different length are not compared. Repeated rows are vectors of their own.
    """
    vectors = saved(_usable(own_columns(table, vec_id=id_col, embedding=vector_col, label=label_col)), "vectors")
    distinct = saved(nodes(vectors), "nodes")
    graph = _start(distinct, k, tables, seed)
    for turn in range(max_turns):
        for _ in range(rounds):
            graph = _refined(graph, distinct, k)
        links = graph.where(F.col("cosine") >= threshold)
        both = saved(links.select("node", "near").unionByName(
            links.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "links")
        roots = components(both.select(F.col("node").alias("a"), F.col("near").alias("b")))
        full = links.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("node")
        homes = saved(roots.join(roots.join(full, "node").select("root").distinct(), "root").select("node"), "homes")
        searched = _exact(homes, distinct, threshold)
        unsearched = both.join(homes, "node", "left_anti").join(homes.withColumnRenamed("node", "near"), "near", "left_anti")
        listed = unsearched.join(distinct.select(F.col("node").alias("near"), "copies"), "near").select(
            "node", F.col("copies").alias("linked"))
        counted = saved(_sums(searched.select("node", "linked").unionByName(listed)), "link-counts")
        recall = _audit(distinct, counted, threshold)
        if recall is None or recall >= target:
            break
        k *= 2
        graph = graph.unionByName(_start(distinct, k, tables, seed + turn + 1))
    edges = both.select(F.col("node").alias("a"), F.col("near").alias("b"))
    if recall is None or recall < target:
        searched, recall = _exact(distinct, distinct, threshold), 1.0
        counted = saved(_sums(searched), "link-counts")
    roots = components(edges.unionByName(_edges_of(searched)))
    placed = distinct.select("node", "copies", "least").join(roots, "node", "left").join(counted, "node", "left")
    placed = placed.select("node", "least", F.coalesce("root", "node").alias("root"),
                           (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    found = placed.join(smallest, "root").select("node", "n_links", "component_id")
    out = vectors.join(found, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("recall"))

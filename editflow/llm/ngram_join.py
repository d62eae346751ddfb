"""N-gram Jaccard join with token-combination prefixes.

Tokens are shingle hashes. In any global token order, two sets with Jaccard similarity of at
least ``percent`` share a token among the first ``n - ceil(percent n) + 1`` of each (prefix),
and two among the first ``n - ceil(percent n) + 2`` (extended prefix).

1. Every text gives its set's size and fingerprint; equal sets are one class.
2. A fixed share of the hash space (``first_share``) is counted over all texts. Tokens of it
   that no other class has come first in the order, so a class with a whole prefix of them has
   no partner at all and leaves. This drops what has text enough of its own.
3. The survivors' sets are written, all their tokens are counted, and the order is by class
   frequency, rarest first. The extended prefixes are written, one row a token.
4. Candidates are verified on the sets. Only connection matters, so each prefix token first links
   its classes to one of them (a star, twice with different centres).
5. Tokens whose classes are all in one component are done; of a pair between components every shared
   token is left. For those the classes are indexed by single tokens where a token is rare and by
   the pairs of the extended prefix's frequent tokens otherwise. Where rare ends is chosen by cost: as low
   as the pairs are no more rows than the single tokens they stand for, so the index grows with its input.
6. Stars over that index are repeated (``STAR_ROUNDS``) while they find links; then the classes of a key that are still
   in different components are compared in blocks, where their sets are. No link between components
   is left out, and no group is ever written out as pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import few_files, own_columns, saved
from editflow.llm.components import components
from editflow.llm.shingles import fingerprint, mixed, shingle_sets

_BLOCK, _COLUMNS = 256, 8192
COUNTED = 65_536  # class counts are exact up to here; more frequent tokens stand last, in hash order
STAR_ROUNDS = 2  # at most; what they leave is compared in blocks
BROADCAST_ROWS = 1_000_000  # 16 bytes a row: a checked bound; beyond it the join shuffles


def prefix_length(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def _summaries(words: int, first_share: float):
    limit = np.uint64(int(first_share * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, early, one, two = [], [], [], []
            for tokens in shingle_sets(batch.column(1), words):
                a, b = fingerprint(tokens)
                n.append(len(tokens))
                early.append(int(np.searchsorted(tokens, limit)))
                one.append(a)
                two.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(early, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64())], names=["doc_id", "n", "n_early", "cls", "check"])
    return run


def _early_tokens(words: int, first_share: float):
    """(token, cls) of the counted share of the hash space; a class once for each task."""
    limit = np.uint64(int(first_share * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts, owners = [], []
            for tokens in shingle_sets(batch.column(0), words):
                early = tokens[:np.searchsorted(tokens, limit)]
                cls = fingerprint(tokens)[0] if len(early) else None
                if cls is not None and cls not in seen:
                    seen.add(cls)
                    parts.append(early)
                    owners.append(np.full(len(early), cls, dtype=np.int64))
            yield _token_rows(parts, owners)
    return run


def _token_rows(parts: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
    tokens = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    cls = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(cls)], names=["token", "cls"])


def _frequencies(frequent: int):
    """Rows sorted by (token, cls) -> (cls, token, df) of tokens that several classes hold.

    ``df`` is exact up to ``frequent`` and ``frequent + 1`` beyond; at most that many rows of a
    token are held back, so a token of any number of classes streams through.
    """

    def emit(tokens: np.ndarray, cls: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(cls), pa.array(tokens), pa.array(df.astype(np.int32))], names=["cls", "token", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t = held_c = np.zeros(0, dtype=np.int64)
        hot = last = None  # token known as frequent; last row, for repeated ones
        for batch in batches:
            t, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(t):
                continue
            new = np.ones(len(t), dtype=bool)
            new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            new[0] = last != (t[0], c[0])
            last = (t[-1], c[-1])
            t, c = t[new], c[new]
            if hot is not None and len(t):
                k = int(np.argmax(t != hot)) if (t != hot).any() else len(t)
                if k:
                    yield emit(t[:k], c[:k], np.full(k, frequent + 1))
                t, c = t[k:], c[k:]
                if len(t):
                    hot = None
            t, c = np.concatenate([held_t, t]), np.concatenate([held_c, c])
            if not len(t):
                continue
            begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            cut = int(begin[-1])
            sizes = np.diff(begin)
            df = np.repeat(np.minimum(sizes, frequent + 1), sizes)
            several = df > 1
            if several.any():
                yield emit(t[:cut][several], c[:cut][several], df[several])
            held_t, held_c = t[cut:], c[cut:]
            if len(held_t) > frequent:
                yield emit(held_t, held_c, np.full(len(held_t), frequent + 1))
                hot, held_t, held_c = held_t[0], held_t[:0], held_c[:0]
        if len(held_t) > 1:
            yield emit(held_t, held_c, np.full(len(held_t), len(held_t)))

    return run


def _survivor_sets(words: int):
    """Sets of the chosen rows (cls, text): rows whose text is of another class go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            cls, n, sets = [], [], []
            for wanted, tokens in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), words), strict=True):
                if wanted not in seen and fingerprint(tokens)[0] == wanted:
                    seen.add(wanted)
                    cls.append(wanted)
                    n.append(len(tokens))
                    sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "n", "tokens"])
    return run


def _set_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [np.frombuffer(x, dtype=np.uint64) for x in batch.column(1).to_pylist()]
        owners = [np.full(len(p), c, dtype=np.int64) for c, p in zip(batch.column(0).to_pylist(), parts, strict=True)]
        yield _token_rows(parts, owners)


def _prefixes(percent: int):
    """(cls, n, held) -> (token, cls, n, df, extra); ``held`` are the class's shared tokens as (df, token), in order.

    ``extra`` marks the one token by which the extended prefix is longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy()
            all_df = lists.values.field("df").to_numpy()
            all_tokens = lists.values.field("token").to_numpy()
            at, owners, sizes, extra = [], [], [], []
            for k, (cls, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                held = int(ends[k + 1] - ends[k])
                length = prefix_length(n, percent) - (n - held)  # unique tokens come first
                if length <= 0:
                    continue
                m = min(length + 1, held)
                at.append(np.arange(ends[k], ends[k] + m))
                owners.append(np.full(m, cls, dtype=np.int64))
                sizes.append(np.full(m, n, dtype=np.int64))
                extra.append(np.arange(m) >= length)
            none = np.zeros(0, dtype=np.int64)
            at = np.concatenate(at) if at else none
            yield pa.RecordBatch.from_arrays(
                [pa.array(all_tokens[at]), pa.array(np.concatenate(owners) if owners else none),
                 pa.array(np.concatenate(sizes) if sizes else none), pa.array(all_df[at]),
                 pa.array(np.concatenate(extra) if extra else none.astype(bool))], names=["token", "cls", "n", "df", "extra"])
    return run


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, n, root, tokens) -> (key, cls, n, root): a key for each pair of a class's tokens."""
    for batch in batches:
        for cls, n, root, tokens in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            t = np.sort(np.asarray(tokens, dtype=np.int64).view(np.uint64))
            i, j = np.triu_indices(len(t), 1)
            key = mixed(t[i] * np.uint64(3) + mixed(t[j])).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), *(pa.array(np.full(len(key), x, dtype=np.int64)) for x in (cls, n, root))],
                names=["key", "cls", "n", "root"])


def _rare_end(apart: DataFrame) -> int:
    """The class count up to which tokens are indexed one by one: the least power of two for which the
    pairs of the more frequent ones aren't more rows than those tokens themselves."""
    ends = [1 << k for k in range(1, 40)]
    counts = apart.groupBy("cls").agg(*(F.count_if(F.col("df") > e).alias(f"m{e}") for e in ends))
    costs = counts.agg(*(F.sum(F.col(f"m{e}") * (F.col(f"m{e}") - 1) / 2).alias(f"p{e}") for e in ends),
                       *(F.sum(f"m{e}").alias(f"t{e}") for e in ends)).first()
    return next(e for e in ends if (costs[f"p{e}"] or 0) <= (costs[f"t{e}"] or 0))


def _between_keys(apart: DataFrame, frequent: int | None) -> DataFrame:
    """(key, cls, n, root) over the tokens between components: rare ones singly, frequent ones in pairs."""
    end = frequent or _rare_end(apart)
    single = apart.where((F.col("df") <= end) & ~F.col("extra")).select(F.col("token").alias("key"), "cls", "n", "root")
    many = apart.where(F.col("df") > end).groupBy("cls").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.collect_list("token").alias("tokens")).where(F.size("tokens") > 1)
    pairs = many.select("cls", "n", "root", "tokens").mapInArrow(_combined, "key long, cls long, n long, root long")
    return single.unionByName(pairs)


def _apart(keys: DataFrame, key: str = "key") -> DataFrame:
    """The rows of keys whose classes are in different components."""
    split = keys.groupBy(key).agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select(key)
    return keys.join(split, key)


def _rooted(keys: DataFrame, joined: DataFrame) -> DataFrame:
    return keys.drop("root").join(joined, keys["cls"] == joined["node"], "left").withColumn(
        "root", F.coalesce("root", "cls")).drop("node")


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(k).to_pylist() for k in range(4))
            keep = []
            for p, q in zip(x, y, strict=True):
                p, q = np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, k in zip(a, keep, strict=True) if k], pa.int64()),
                 pa.array([v for v, k in zip(b, keep, strict=True) if k], pa.int64())], names=["a", "b"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    x = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    rows = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(_similar(percent), "a long, b long")


def _sizes_fit(percent: int, n: str, m: str):
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _star(keys: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs of each class with its key's centre, but for those in one component: as many as rows at most."""
    centre = keys.groupBy("key").agg(
        F.min_by(F.struct("cls", "n", "root"), F.struct(F.xxhash64(F.lit(seed), "cls"), "cls")).alias("c"))
    near = keys.join(centre, "key").where(F.col("root") != F.col("c.root")).where(_sizes_fit(percent, "n", "c.n"))
    return near.select(F.least("cls", "c.cls").alias("a"), F.greatest("cls", "c.cls").alias("b")).distinct()


def _block_links(percent: int):
    """Rows of one pair of blocks together: a link for each two components that have one there."""

    def overlaps(left: list[tuple], right: list[tuple]) -> np.ndarray:
        x, y = [r[4] for r in left], [r[4] for r in right]
        all_x, all_y = np.concatenate(x), np.concatenate(y)
        shared = np.intersect1d(all_x, all_y)
        row_x, row_y = np.repeat(np.arange(len(x)), list(map(len, x))), np.repeat(np.arange(len(y)), list(map(len, y)))
        out = np.zeros((len(x), len(y)), dtype=np.float32)

        def columns(tokens, rows):
            at = np.minimum(np.searchsorted(shared, tokens), max(len(shared) - 1, 0))
            known = shared[at] == tokens if len(shared) else np.zeros(len(tokens), dtype=bool)
            order = np.argsort(at[known], kind="stable")
            return at[known][order], rows[known][order]

        (at_x, row_x), (at_y, row_y) = columns(all_x, row_x), columns(all_y, row_y)
        for low in range(0, len(shared), _COLUMNS):
            a, b = np.searchsorted(at_x, [low, low + _COLUMNS])
            c, d = np.searchsorted(at_y, [low, low + _COLUMNS])
            m = np.zeros((len(x), min(_COLUMNS, len(shared) - low)), dtype=np.float32)
            w = np.zeros((len(y), m.shape[1]), dtype=np.float32)
            m[row_x[a:b], at_x[a:b] - low] = 1
            w[row_y[c:d], at_y[c:d] - low] = 1
            out += m @ w.T
        return out

    def links(rows: list[tuple], same: bool, group: int) -> list[tuple[int, int]]:
        left = [r for r in rows if r[0]]
        right = left if same else [r for r in rows if not r[0]]
        if not left or not right:
            return []
        common = overlaps(left, right)
        n, m = np.array([len(r[4]) for r in left]), np.array([len(r[4]) for r in right])
        ok = 100 * common >= percent * (n[:, None] + m[None, :] - common)
        root_x, root_y = np.array([r[2] for r in left]), np.array([r[2] for r in right])
        ok &= root_x[:, None] != root_y[None, :]
        kind_x, kind_y = np.array([r[3] for r in left]), np.array([r[3] for r in right])
        ok &= np.minimum(kind_x[:, None], kind_y[None, :]) == group  # the others meet in the next group
        found = {}
        for i, j in zip(*np.nonzero(ok), strict=True):
            found.setdefault((min(root_x[i], root_y[j]), max(root_x[i], root_y[j])), (left[i][1], right[j][1]))
        return list(found.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in range(9))
            for centre, group, i, j, left, cls, root, kind, tokens in zip(*columns, strict=True):
                if (centre, group, i, j) != key:
                    if rows:
                        out += links(rows, key[2] == key[3], key[1])
                    key, rows = (centre, group, i, j), []
                rows.append((left, cls, root, kind, np.frombuffer(tokens, dtype=np.uint64)))
            yield _pairs(out)
        if rows:
            yield _pairs(links(rows, key[2] == key[3], key[1]))

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _between_components(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different components that share an index key.

    Keys of one neighbourhood mostly have the same centre (the class of least hash), so every
    candidate pair lies in the group of its key's centre, and a class joins each such group
    once instead of once for every key. Groups are cut by size (a factor of the threshold; a
    pair lies in one class of sizes or in two next to each other) and compared in pairs of blocks:
    pairs are counted where the sets are, and only links leave the task.
    """
    centre = apart.groupBy("key").agg(F.min_by("cls", F.struct(F.xxhash64(F.lit(3), "cls"), "cls")).alias("centre"))
    # A little more than the threshold's ratio, so that rounding never parts a pair by two classes.
    ratio = 1.001 * max(float(np.log(100 / percent)), 0.01)
    kind = F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int")
    members = apart.join(centre, "key").select("centre", "cls", "root", kind.alias("kind")).distinct()
    members = members.select("*", F.explode(F.array(F.col("kind") - 1, F.col("kind"))).alias("group"))
    groups = members.groupBy("centre", "group").agg(
        F.count("*").alias("size"), F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    x = members.join(groups, ["centre", "group"])
    x = x.withColumn("blocks", F.expr(f"cast((size + {_BLOCK} - 1) div {_BLOCK} as int)"))
    x = x.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "cls"), F.col("blocks")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.select("centre", "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                 (F.col("block") <= F.col("other")).alias("left"), "cls", "root", "kind")
    x = x.join(sets.select("cls", "tokens"), "cls").select("centre", "group", "i", "j", "left", "cls", "root", "kind", "tokens")
    together = x.repartition("centre", "group", "i", "j").sortWithinPartitions("centre", "group", "i", "j")
    return together.mapInArrow(_block_links(percent), "a long, b long").distinct()


def link(docs: DataFrame, words: int = 4, percent: int = 85, first_share: float = 0.25, frequent: int | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest id reachable by links, the row's own included. Null texts
    are empty; texts without words link with nothing. A null id stays alone and has a null
    component. Components are formed over texts: rows that share an id and differ in text each follow
    their own text, and each row is returned. ``frequent`` fixes the class count above which tokens are
    indexed in pairs; by default cost decides.
    """
    rows = own_columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    summary = saved(
        rows.mapInArrow(_summaries(words, first_share), "doc_id long, n long, n_early long, cls long, check long"), "sets")
    named = summary.where("n > 0 AND doc_id IS NOT NULL")
    classes = named.groupBy("cls").agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.max("n_early").alias("n_early"))

    tokens = rows.where("doc_id is not null").select("text").mapInArrow(_early_tokens(words, first_share), "token long, cls long")
    tokens = tokens.repartition("token").sortWithinPartitions("token", "cls")
    shared = tokens.mapInArrow(_frequencies(1), "cls long, token long, df int").groupBy("cls").agg(F.count("*").alias("n_shared"))
    need = F.col("n") + 1 - F.ceil(F.col("n") * percent / 100)
    survivors = saved(
        classes.join(shared, "cls", "left").where(F.col("n_early") - F.coalesce("n_shared", F.lit(0)) < need)
        .select("cls", "least"), "join-survivors")

    chosen = survivors.withColumnRenamed("least", "doc_id")
    if survivors.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    sets = saved(
        rows.join(chosen, "doc_id").select("cls", "text").mapInArrow(_survivor_sets(words), "cls long, n long, tokens binary"),
        "join-sets")

    every = sets.select("cls", "tokens").mapInArrow(_set_tokens, "token long, cls long")
    every = every.repartition("token").sortWithinPartitions("token", "cls")
    counted = every.mapInArrow(_frequencies(COUNTED), "cls long, token long, df int")
    held = counted.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held"))
    prefixes = saved(
        held.join(sets.select("cls", "n").distinct(), "cls").select("cls", "n", "held")
        .mapInArrow(_prefixes(percent), "token long, cls long, n long, df int, extra boolean"), "join-prefixes")

    rows_held = prefixes.count()
    single = prefixes.where("not extra").select(F.col("token").alias("key"), "cls", "n", F.col("cls").alias("root"))
    stars = _star(single, 1, percent).unionByName(_star(single, 2, percent)).distinct()
    stars = saved(few_files(stars, 2 * rows_held), "join-stars")
    links = saved(few_files(_verified(stars, sets, percent), 2 * rows_held), "join-links")
    joined = components(links)
    # What two stars left apart: the tokens between components, indexed anew.
    apart = saved(few_files(_apart(_rooted(prefixes, joined), "token"), rows_held), "join-apart")
    keys = saved(_apart(_between_keys(apart, frequent)), "join-keys")
    for seed in range(3, 3 + STAR_ROUNDS):
        n_keys = keys.count()
        more = saved(few_files(_verified(_star(keys, seed, percent), sets, percent), n_keys), "join-links")
        if more.isEmpty():
            break
        links = links.unionByName(more)
        joined = components(links)
        keys = saved(few_files(_apart(_rooted(keys, joined)), n_keys), "join-keys")
    more = saved(_between_components(keys, sets, percent), "join-links")
    final = components(links.unionByName(more)) if more.head(1) else joined

    roots = classes.join(final, classes["cls"] == final["node"], "left").select(
        "cls", "least", F.coalesce("root", "cls").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component"))
    found = roots.join(smallest, "root").select("cls", "component")
    return summary.join(found, "cls", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))

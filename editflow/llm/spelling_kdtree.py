"""Spelling variants by k-d trees over letter-count vectors.

One inserted, deleted or replaced letter moves a word's vector of letter counts by an L1 distance of
one (lengths l and l + 1: one count up) or exactly two (equal lengths: one up, one down). For each
length a k-d tree of split planes deals the words into cells; a word searches the cells that its box
reaches, in the trees of its own length and the next. Inside a cell a finer k-d tree is built over the
words and searched by whole batches of boxes; letter order is verified at its leaves.

The planes of the upper trees come from a bounded sample of vectors. They decide only where words lie:
a box that cannot leave a plane's side is pruned exactly, so every pair is found once whatever the planes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved

# The letters of a word, and the least length and count of a word that takes part.
RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 7, 2
DOMINANCE = 10  # a form has at least so many times its variant's occurrences
DELETE_EVERY = 31  # of the seeded misspellings

SAMPLE = 100_000  # vectors that the split planes are learned from, at most about so many
CELL_WORDS = 4_096  # words of a cell that the planes aim at
BLOCK_WORDS = 4 * CELL_WORDS  # a cell with more words is searched in blocks
LEAF_WORDS = 32  # words of a leaf inside a cell
QUERY_BATCH = 8_192
PAIR_BYTES = 1 << 24  # of a block of comparisons

# Letters as rows of a word's vector: a-z, then the sixty-four above 0xC0 (nothing is folded there).
_LETTER = np.full(256, 0, dtype=np.int64)
_LETTER[ord("a"):ord("z") + 1] = np.arange(26)
_LETTER[0xC0:] = 26 + np.arange(64)
LETTERS = 90


def vectors(letters: np.ndarray) -> np.ndarray:
    """Letter counts (words x letters) of equally long words (words x length, Latin-1 codes)."""
    m = len(letters)
    at = (np.arange(m)[:, None] * LETTERS + _LETTER[letters]).ravel()
    return np.bincount(at, minlength=m * LETTERS).reshape(m, LETTERS).astype(np.int32)


def _plane(v: np.ndarray) -> tuple[int, int] | None:
    """The (letter, count) that halves the vectors best; None if all are equal."""
    found = (2.0, -1, 0)
    for t in (1, 2, 3):
        share = (v >= t).mean(0)
        off = np.where((share > 0) & (share < 1), np.abs(share - 0.5), 2.0)
        k = int(off.argmin())
        if off[k] < found[0]:
            found = (float(off[k]), k, t)
    if found[1] >= 0:
        return found[1], found[2]
    low, high = v.min(0), v.max(0)
    k = int((high - low).argmax())
    if low[k] == high[k]:
        return None
    t = min(int(np.median(v[:, k])) + 1, int(high[k]))
    return k, max(t, int(low[k]) + 1)


class Tree:
    """Split planes over count vectors; a leaf holds what ``leaf(rows)`` made of its rows."""

    def __init__(self, v: np.ndarray, size: float, leaf):
        self.root = self._build(v, np.arange(len(v)), size, leaf)

    def _build(self, v, rows, size, leaf):
        plane = _plane(v[rows]) if len(rows) > size else None
        if plane is None:
            return leaf(rows)
        k, t = plane
        right = v[rows, k] >= t
        return k, t, self._build(v, rows[~right], size, leaf), self._build(v, rows[right], size, leaf)

    def visit(self, v: np.ndarray, rows: np.ndarray, up: bool, down: bool) -> Iterator[tuple[object, np.ndarray]]:
        """(leaf, queries) for each leaf that a query's box reaches: at most one count up and one down."""
        start = (self.root, rows, np.full(len(rows), up), np.full(len(rows), down))
        stack = [start]
        while stack:
            node, q, ups, downs = stack.pop()
            if not len(q):
                continue
            if not isinstance(node, tuple):
                yield node, q
                continue
            k, t, left, right = node
            x = v[q, k]
            below = x < t
            go = below | ((x == t) & downs)
            stack.append((left, q[go], ups[go], (downs & below)[go]))
            go = ~below | ((x == t - 1) & ups)
            stack.append((right, q[go], (ups & ~below)[go], downs[go]))


# ------------------------------------------------------------------------------ words

def seeded_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least seven letters and two occurrences, with seeded misspellings.

    A run of letters loses one where 31 divides the CRC-32 of ``<id>:<run>``. Null texts have no words;
    a null id counts as empty in the hash. Repeated rows count each time. An empty table has no words.
    """
    own = own_columns(docs, doc=id_col, text=text_col)
    runs = own.select(
        F.coalesce(F.col("doc").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all("text", F.lit(f"({RUN}{{{MIN_LENGTH},}})"), F.lit(1))).alias("run"),
    ).select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DELETE_EVERY == 0, less).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, letters) for each length among the words."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.frombuffer(b"".join(words[k] for k in at), dtype=np.uint8).reshape(len(at), size)


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


def _vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for size, _, letters in _by_length(_latin(batch.column(0))):
            v = np.minimum(vectors(letters), 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict(
                {"size": pa.array([size] * len(v), pa.int32()), "v": pa.array([x.tobytes() for x in v], pa.binary())})


def planes(words: DataFrame) -> dict[int, Tree]:
    """A tree for each length with more words than a cell; its leaves are numbered cells.

    Learned from at most about ``SAMPLE`` vectors of 90 bytes, chosen by hash among the words of those
    lengths. Counts above 255 are clipped here, which only keeps planes from lying higher.
    """
    sizes = {r["size"]: r["n"] for r in words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n"))
             .where(F.col("n") > CELL_WORDS).collect()}
    if not sizes:
        return {}
    share = min(1.0, SAMPLE / sum(sizes.values()))
    chosen = words.where(F.length("word").isin(*sizes) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))))
    rows = chosen.select("word").mapInArrow(_vectors_of, "size int, v binary").collect()
    trees = {}
    for size, n in sizes.items():
        v = [r["v"] for r in rows if r["size"] == size]
        v = np.frombuffer(b"".join(v), dtype=np.uint8).reshape(len(v), LETTERS)
        cells: list[int] = []

        def leaf(_):
            cells.append(len(cells))
            return cells[-1]

        trees[size] = Tree(v, max(8, len(v) * CELL_WORDS / n), leaf)
    return trees


_HOME = "size int, cell int"
_DEALT = "size int, cell int, block int, kind int, word binary, n long"
# Kinds of rows in a cell, the index first. OWN is a query in the cell of its own word: it takes only the
# words above it, so that no pair comes twice.
INDEX, SAME, SHORTER, OWN = range(4)


def _homes(trees: dict[int, Tree]):
    def run(batches):
        for batch in batches:
            for size, at, letters in _by_length(_latin(batch.column(0))):
                for cell, q in _cells(trees, size, vectors(letters), np.arange(len(at)), False, False):
                    yield pa.RecordBatch.from_pydict({"size": pa.array([size] * len(q), pa.int32()),
                                                      "cell": pa.array([cell] * len(q), pa.int32())})
    return run


def _cells(trees, size, v, rows, up, down):
    return trees[size].visit(v, rows, up, down) if size in trees else [(0, rows)]


def _deal(trees: dict[int, Tree], blocks: dict[tuple[int, int], int]):
    """Each word into its cell, and as a query into every cell (and block) that its box reaches.

    Of two cells that reach each other only the lower one's words search the upper one.
    """
    def run(batches):
        for batch in batches:
            words, n = _latin(batch.column(0)), batch.column(1).to_numpy()
            for size, at, letters in _by_length(words):
                v, rows = vectors(letters), np.arange(len(at))
                home = np.zeros(len(at), dtype=np.int64)
                out = []
                for cell, q in _cells(trees, size, v, rows, False, False):
                    home[q] = cell
                    of = blocks.get((size, cell), 1)
                    block = np.array([zlib.crc32(words[k]) % of for k in at[q]]) if of > 1 else np.zeros(len(q), dtype=np.int64)
                    out.append((INDEX, size, cell, q, block))
                for kind, of_size, down in ((SAME, size, True), (SHORTER, size + 1, False)):
                    for cell, q in _cells(trees, of_size, v, rows, True, down):
                        if kind == SAME:
                            q = q[home[q] <= cell]
                        for b in range(blocks.get((of_size, cell), 1)):
                            out.append((kind, of_size, cell, q, np.full(len(q), b)))
                cols = [np.concatenate([np.full(len(x[3]), x[k]) for x in out]) for k in range(3)]
                picked = np.concatenate([x[3] for x in out])
                kinds = np.where((cols[0] == SAME) & (home[picked] == cols[2]), OWN, cols[0])
                yield pa.RecordBatch.from_pydict({
                    "size": pa.array(cols[1], pa.int32()), "cell": pa.array(cols[2], pa.int32()),
                    "block": pa.array(np.concatenate([x[4] for x in out]), pa.int32()),
                    "kind": pa.array(kinds, pa.int32()),
                    "word": pa.array([words[k] for k in at[picked]], pa.binary()), "n": pa.array(n[at[picked]], pa.int64())})
    return run



# ------------------------------------------------------------------------------ inside a cell

def _replaced(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equally long words that differ in exactly one place."""
    if q.shape[1] > 64:
        near = (q[:, None, :] != x[None]).sum(2) == 1
    else:
        off = np.zeros((len(q), len(x)), dtype=np.uint8)
        for p in range(q.shape[1]):
            off += q[:, p, None] != x[None, :, p]
        near = off == 1
    return np.nonzero(near)


def _inserted(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs where the longer word is the shorter one with one letter put in."""
    size = q.shape[1]
    if size > 64:
        pre = np.logical_and.accumulate(q[:, None, :] == x[None, :, :-1], axis=2).sum(2)
        suf = np.logical_and.accumulate((q[:, None, :] == x[None, :, 1:])[:, :, ::-1], axis=2).sum(2)
        return np.nonzero(pre + suf >= size)
    common = np.zeros((len(q), len(x)), dtype=np.uint8)
    for places, shift in ((range(size), 0), (range(size - 1, -1, -1), 1)):
        alive = np.ones(common.shape, dtype=bool)
        for p in places:
            alive &= q[:, p, None] == x[None, :, p + shift]
            common += alive
    return np.nonzero(common >= size)


def _in_blocks(verify, q: np.ndarray, x: np.ndarray, rows: np.ndarray, leaf: np.ndarray):
    step = max(1, PAIR_BYTES // max(1, len(leaf) * (q.shape[1] if q.shape[1] > 64 else 1)))
    for k in range(0, len(rows), step):
        i, j = verify(q[rows[k:k + step]], x[leaf])
        yield rows[k:k + step][i], leaf[j]


def _looked_up(q: np.ndarray, x: np.ndarray, rows: np.ndarray, leaf: np.ndarray, vq: np.ndarray, point: np.ndarray):
    """The same pairs in a leaf whose many words have one vector: put the letter that is missing into each
    place it can have and look the result up, so work grows with queries and not with pairs."""
    codes = np.concatenate([np.arange(97, 123), np.arange(0xC0, 0x100)])
    held = {x[k].tobytes(): k for k in leaf}
    i, j = [], []
    for r in rows:
        d = point - vq[r]
        if np.abs(d).sum() != x.shape[1] - q.shape[1] + 2 * (x.shape[1] == q.shape[1]):
            continue
        word, more = q[r].tobytes(), bytes([codes[int(d.argmax())]])
        if x.shape[1] == q.shape[1]:
            gone = codes[int(d.argmin())]
            tries = {word[:p] + more + word[p + 1:] for p in np.flatnonzero(q[r] == gone)}
        else:
            tries = {word[:p] + more + word[p:] for p in range(len(word) + 1)}
        for k in sorted(held[t] for t in tries if t in held):
            i.append(r)
            j.append(k)
    yield np.array(i, dtype=np.int64), np.array(j, dtype=np.int64)


class Cell:
    """The index words of one cell under a k-d tree."""

    def __init__(self, letters: np.ndarray, n: np.ndarray):
        self.letters, self.n = letters, n
        self.v = vectors(letters)
        self.tree = Tree(self.v, LEAF_WORDS, lambda rows: rows)

    def pairs(self, q: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all near pairs of a batch of equally long queries."""
        same = q.shape[1] == self.letters.shape[1]
        verify, vq, found = (_replaced if same else _inserted), vectors(q), []
        for leaf, rows in self.tree.visit(vq, np.arange(len(q)), True, same):
            if len(leaf) > 8 * LEAF_WORDS:  # only words with one vector cannot be split further
                found.extend(_looked_up(q, self.letters, rows, leaf, vq, self.v[leaf[0]]))
            else:
                found.extend(_in_blocks(verify, q, self.letters, rows, leaf))
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, dtype=np.int64) for k in (0, 1))
        if kind == OWN and len(i):
            a, b = q[i], self.letters[j]
            p = (a != b).argmax(1)
            up = a[np.arange(len(i)), p] < b[np.arange(len(i)), p]
            i, j = i[up], j[up]
        return i, j


def _strings(letters: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(letters).view(f"S{letters.shape[1]}").ravel()


_NEAR = "word binary, n_near long, best_n long, best binary"


def _summary(i: np.ndarray, j: np.ndarray, of: np.ndarray, others: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For each word of ``of`` among ``i``: how many of ``others`` are near, and the first by (n, word)."""
    rank = np.empty(len(others), dtype=np.int64)
    rank[np.argsort(others, kind="stable")] = np.arange(len(others))
    order = np.lexsort((rank[j], -n[j], i))
    i, j = i[order], j[order]
    start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    return pa.RecordBatch.from_pydict({
        "word": pa.array(of[i[start]].tolist(), pa.binary()),
        "n_near": pa.array(np.diff(np.r_[start, len(i)]), pa.int64()), "best_n": pa.array(n[j[start]], pa.int64()),
        "best": pa.array(others[j[start]].tolist(), pa.binary())})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (size, cell, block, kind): the index of a cell, then its queries by kind."""
    key, index, cell, held, kind = None, [], None, [], None

    def letters_of(parts, size):
        return np.frombuffer(b"".join(w for words, _ in parts for w in words), dtype=np.uint8).reshape(-1, size)

    def flush():
        if cell is None or not held:
            return
        q = letters_of(held, key[0] - (kind == SHORTER))
        qn = np.concatenate([n for _, n in held])
        i, j = cell.pairs(q, kind)
        if len(i):
            qs, xs = _strings(q), _strings(cell.letters)
            yield _summary(i, j, qs, xs, cell.n)
            yield _summary(j, i, xs, qs, qn)

    for batch in batches:
        size, at, block, kinds, n = (batch.column(k).to_numpy() for k in (0, 1, 2, 3, 5))
        words = batch.column(4).to_pylist()
        cuts = np.flatnonzero(np.r_[True, (np.diff(size) != 0) | (np.diff(at) != 0) | (np.diff(block) != 0) | (np.diff(kinds) != 0)])
        for a, b in zip(cuts, np.r_[cuts[1:], len(words)], strict=True):
            now = (int(size[a]), int(at[a]), int(block[a]))
            if now != key or kinds[a] != kind:
                yield from flush()
                held = []
                if now != key:
                    key, index, cell = now, [], None
                kind = int(kinds[a])
            part = (words[a:b], n[a:b])
            if kind == INDEX:
                index.append(part)
                continue
            if cell is None and index:
                cell = Cell(letters_of(index, key[0]), np.concatenate([c for _, c in index]))
            held.append(part)
            if sum(len(w) for w, _ in held) >= QUERY_BATCH:
                yield from flush()
                held = []
    yield from flush()


# ------------------------------------------------------------------------------ operator

def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, near, near_n) for every row of ``words`` (distinct words with counts n).

    ``n_near`` counts the words at exactly one inserted, deleted or replaced letter; ``near`` is the
    one with the largest n (ties: the least word), null if there is none. Words are made of a-z and
    the letters U+00C0 to U+00FF. An empty table gives an empty table.
    """
    trees = planes(words)
    homes = words.select("word").mapInArrow(_homes(trees), _HOME)
    heavy = homes.groupBy("size", "cell").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_WORDS).collect()
    blocks = {(r["size"], r["cell"]): -(-r["n"] // BLOCK_WORDS) for r in heavy}
    dealt = words.select("word", "n").mapInArrow(_deal(trees, blocks), _DEALT)
    keys = ["size", "cell", "block"]
    near = dealt.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(_search, _NEAR)
    text = lambda c: F.decode(F.col(c), "ISO-8859-1")
    part = near.select(text("word").alias("word"), "n_near", F.struct((-F.col("best_n")).alias("m"), text("best").alias("w")).alias("best"))
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"))
    both = own.unionByName(part, allowMissingColumns=True).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return both.select("word", "n", "n_near", F.col("best.w").alias("near"), (-F.col("best.m")).alias("near_n"))


def group(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n): spelling variants under their forms.

    A word's form is its near word of largest n if that is at least ten times its own; the root follows
    forms to the last one (the word itself if it has no form). Counts rise tenfold with each form, so
    chains are short and pointer doubling ends after a few rounds.
    """
    near = saved(near_words(saved(words.select("word", "n"), "spelling-words")), "spelling-near")
    is_form = F.col("near_n") >= DOMINANCE * F.col("n")
    formed = near.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"),
                         F.when(is_form, F.col("near_n")).alias("form_n"))
    root = saved(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-root")
    while True:
        further = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = saved(root.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-root")
        root = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return formed.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

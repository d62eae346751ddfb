"""Spelling variants against a comparison of all pairs and against deletion neighbourhoods."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from editflow.llm import queries
from editflow.llm import spelling_kdtree as sk

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_words(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= 7
    return {w: c for w, c in n.items() if c >= 2}


def plain_near(words):
    """Near words by what is left when one letter is taken out or masked."""
    keys = collections.defaultdict(set)
    for w in words:
        keys[w].add(w)
        for k in range(len(w)):
            keys[w[:k] + w[k + 1:]].add(w)
            keys[w[:k] + "*" + w[k + 1:]].add(w)
    near = collections.defaultdict(set)
    for held in keys.values():
        for a, b in itertools.combinations(held, 2):
            if one_edit(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def plain_group(words):
    near, form = plain_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def _documents():
    rng = random.Random(8)
    stems = ["".join(rng.choice(["ther", "ing", "è", "an", "ß", "tion", "Ö", "es", "r", "÷"]) for _ in range(rng.randrange(2, 7)))
             for _ in range(140)]
    rows = []
    for k in range(260):
        words = [rng.choice(stems[: rng.choice([6, 20, 140])]) for _ in range(rng.randrange(1, 60))]
        for i in range(len(words)):
            if rng.random() < 0.2:
                w, p = words[i], rng.randrange(len(words[i]))
                words[i] = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("aeéz") + w[p + 1:], w[:p] + rng.choice("aeÿ") + w[p:]])
        rows.append((None if k % 50 == 7 else k // 2, rng.choice([" ", "\n", "1", ", ", "Ā"]).join(words)))
    giant = "ab" * 1_000
    rows += [(900, None), (901, ""), (902, "short 12345678 中文"), (903, f"{giant} {giant} {giant}c {giant}c")]
    rows += [(904, "aaaaaaa aaaaaaa AAAAAAAA aaaaaaaa aaaaaab aaaaaab"), rows[0], rows[0]]
    rows += [(1000 + k, "chainword " * 30 + "chainwoord " * (3 if k < 9 else 0) + "chainwoordy " * (k < 2)) for k in range(12)]
    return rows


@pytest.mark.parametrize("cell,block,leaf", [(4096, 16384, 32), (40, 25, 4)])
def test_query(spark, tmp_path, monkeypatch, cell, block, leaf):
    monkeypatch.setattr(sk, "CELL_WORDS", cell)
    monkeypatch.setattr(sk, "BLOCK_WORDS", block)
    rows = _documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for extra in ("word", "n", "size", "cell", "doc", "run"):
        df = df.withColumn(extra, F.lit("extra"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_letter_kdtree(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows_out = [tuple(r) for r in got.collect()]
    want = plain_group(plain_words(rows))
    assert set(rows_out) == want and len(rows_out) == len(want)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)


def _pairs(words, kind=sk.OWN):
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
    i, j = sk.Cell(letters, np.ones(len(words), dtype=np.int64)).pairs(letters, kind)
    return {(words[a], words[b]) for a, b in zip(i, j)}, len(i)


def test_anagrams_and_dense_cells():
    """Many words with few letter vectors: leaves that cannot be split further are looked up."""
    words = ["".join(w) for w in itertools.product("abc", repeat=8)]
    found, n = _pairs(words)
    assert n == len(found) == len(words) * 16 // 2 and all(a < b and one_edit(a, b) for a, b in found)
    words = sorted({"".join(p) for p in itertools.permutations("aaabbbcd")})
    letters = np.frombuffer("".join(words).encode(), dtype=np.uint8).reshape(len(words), -1)
    cell = sk.Cell(letters, np.ones(len(words), dtype=np.int64))
    shorter = sorted({w.replace("d", "", 1) for w in words})
    q = np.frombuffer("".join(shorter).encode(), dtype=np.uint8).reshape(len(shorter), -1)
    i, j = cell.pairs(q, sk.SHORTER)
    assert len(i) == len(words) and all(one_edit(shorter[a], words[b]) for a, b in zip(i, j))
    swapped = sorted({w.replace("d", "a", 1) for w in words})
    q = np.frombuffer("".join(swapped).encode(), dtype=np.uint8).reshape(len(swapped), -1)
    i, j = cell.pairs(q, sk.SAME)
    assert {(swapped[a], words[b]) for a, b in zip(i, j)} == {(a, b) for a in swapped for b in words if one_edit(a, b)}


def test_random_words_of_a_cell():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcdé") for _ in range(7)) for _ in range(1500)})
    assert _pairs(words)[0] == {(a, b) for a, b in itertools.combinations(words, 2) if one_edit(a, b)}


def test_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert sk.group(sk.seeded_words(docs)).count() == 0
    assert sk.group(sk.seeded_words(docs.limit(0))).count() == 0

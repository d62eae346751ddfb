"""Embedding and model operators, and the pipeline, on small tables."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from editflow.llm import knn_quality, nn_descent
from editflow.llm.common import saved, table
from editflow.llm.components import components

SF = "/root/testdata/sf0.01"


def _vectors():
    rng = np.random.default_rng(3)
    rows = []
    for g in range(30):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 5)):
            rows.append((len(rows), (centre + 0.05 * rng.standard_normal(16)).tolist(), g % 3))
    hub = rng.standard_normal(16)
    rows += [(len(rows) + k, (hub + 0.02 * rng.standard_normal(16)).tolist(), 1) for k in range(60)]
    n = len(rows)
    rows += [(n, rows[0][1], 0), (n + 1, [2 * v for v in rows[0][1]], 0), (n + 2, rows[0][1], None), (n + 3, None, 0),
             (n + 4, [0.0] * 16, 0), (n + 5, [float("nan")] * 16, 0), (n + 6, [None] + [1.0] * 15, 0), (n + 7, [], 0),
             (n + 8, [1.0] * 3, 0), (n + 9, [float("inf")] * 16, 0), (None, rows[0][1], 0)]
    return rows + [rows[0]]


def test_nn_descent_exact_on_small_data(spark):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.select("*", *(F.lit(1).alias(c) for c in ("node", "part", "vec", "copies", "least", "root", "cosine", "at")))
    usable = [(i, np.array(v, dtype=float), lab) if i is not None and lab is not None and v and None not in v and np.isfinite(v).all()
              and np.any(v) else None for i, v, lab in rows]
    links = np.zeros((len(rows), len(rows)), dtype=bool)
    for i, x in enumerate(usable):
        for j, y in enumerate(usable):
            if x and y and i != j and x[2] == y[2] and len(x[1]) == len(y[1]):
                links[i, j] = x[1] @ y[1] / np.linalg.norm(x[1]) / np.linalg.norm(y[1]) >= 0.98
    label = [r[0] for r in rows]
    for _ in range(len(rows)):
        label = [min([label[i], *(label[j] for j in np.flatnonzero(links[i]))]) if usable[i] else label[i] for i in range(len(rows))]
    want = collections.Counter((r[0], int(links[i].sum()), label[i], r[0] is None or r[0] == label[i]) for i, r in enumerate(rows))
    got = nn_descent.near_duplicates(df)
    assert collections.Counter(tuple(r)[:4] for r in got.collect()) == want
    assert got.first()["recall"] >= 0.95


def _brute(x, label, threshold=0.98):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    root = np.arange(len(x))
    while True:
        least = np.minimum(root, np.where(links, root, len(x)).min(1))
        if (least == root).all():
            return links.sum(1), root
        root = least


def _clusters():
    """Chains of tight clusters (cosine about 0.999) that link with the next cluster only, and noise."""
    rng = np.random.default_rng(8)
    rows, label = [], []
    for chain in range(6):
        basis = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        for step in range(5):
            centre = np.cos(0.17 * step) * basis[0] + np.sin(0.17 * step) * basis[1]
            rows += list(centre + 0.003 * rng.standard_normal((12, 32)))
            label += [chain % 2] * 12
    rows += list(rng.standard_normal((200, 32)))
    return np.array(rows), np.array(label + [0, 1] * 100)


def test_nn_descent_links_between_saturated_clusters(spark):
    x, label = _clusters()
    n_links, root = _brute(x, label)
    df = spark.createDataFrame([(k, v.tolist(), int(c)) for k, (v, c) in enumerate(zip(x, label))],
                               "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert got == {k: (n_links[k], root[k]) for k in range(len(x))}


def test_nn_descent_lost_links_are_searched(spark, monkeypatch):
    """A start that finds hardly any link, in a table of which few vectors are linked."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((1500, 24))
    x[1:40:2] = x[0:40:2] + 0.01 * rng.standard_normal((20, 24))
    label = np.zeros(len(x), dtype=int)
    n_links, root = _brute(x, label)
    df = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(nn_descent, "_start", lambda vectors, *_: spark.createDataFrame([], nn_descent._EDGE))
    monkeypatch.setattr(nn_descent, "_refined", lambda graph, *_: graph)
    monkeypatch.setattr(nn_descent, "SAMPLES", (64, 256), raising=False)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert n_links.sum() >= 40 and got == {k: (n_links[k], root[k]) for k in range(len(x))}


def test_exact_search_by_cells(spark, monkeypatch):
    x, label = _clusters()
    n_links, _ = _brute(x, label)
    df = spark.createDataFrame([(k, (int(c), 32), v.tolist(), 1) for k, (v, c) in enumerate(zip(x, label))],
                               "node long, part struct<label:int,size:int>, vec array<double>, copies long")
    monkeypatch.setattr(nn_descent, "_HOMES", 16)
    monkeypatch.setattr(nn_descent, "_STRIP", 50)
    sums = nn_descent._sums(nn_descent._exact(df.select("node"), df, 0.98, cell=40))
    assert {r["node"]: r["linked"] for r in sums.collect()} == {k: n for k, n in enumerate(n_links.tolist()) if n}


def test_nn_descent_extreme_magnitudes(spark):
    rows = [(1, "a", [1e200, 2e200, 0.0]), (2, "a", [1e-200, 2e-200, 0.0]), (3, "a", [1.0, 2.0, 0.0]), (4, "a", [-1e200, 2e200, 0.0]),
            (5, "a", [5e-324, 1e-323, 0.0]), (6, "a", [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(df).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 3: (3, 1), 4: (0, 4), 5: (3, 1), 6: (0, 6)}


def test_nn_descent_empty(spark):
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(k, k + 1) for k in range(100, 140)] + [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    want = {x: r for x, r in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_classifier_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = knn_quality.fit(docs.withColumn("label", F.lit("x")), labels, per_class=300)
    scored = knn_quality.score(docs, model).join(labels, "doc_id").where(knn_quality.held_out(F.col("doc_id"))).select(
        "quality_score", "quality").toPandas()
    good, bad = scored[scored.quality == 1].quality_score, scored[scored.quality == 0].quality_score
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95
    assert (good >= 0.3).mean() > 0.98


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 40_000), (3, "word"), (None, "some text")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (7, None), (None, 1)], "doc_id long, quality int")
    for given in (labels, labels.where("false")):
        model = knn_quality.fit(docs, given)
        rows = knn_quality.score(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert knn_quality.score(docs.where("false"), model).count() == 0


def test_vote_equals_a_plain_loop():
    rng = np.random.default_rng(4)
    raw = rng.poisson(0.2, (80, knn_quality.N_FEATURES)).astype(np.float32)
    labels = rng.integers(0, 2, 80)
    model = knn_quality.train(raw, labels, 0.4, rank=16, neighbours=7)
    asked = np.concatenate([rng.poisson(0.2, (30, knn_quality.N_FEATURES)).astype(np.float32), raw[:5], raw[:1] * 0])
    got = model.vote(asked)
    for row, share in zip(asked, got, strict=True):
        v = model.project(row[None])[0]
        near = sorted(((float(np.dot(v, w)), int(y)) for w, y in zip(model.vectors, labels)), reverse=True)[:7]
        weights = [max(c, 0.0) ** 8 for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights) if sum(weights) > 1e-6 else 0.4
        assert share == pytest.approx(want, abs=1e-4)


def test_counts_take_little_work_space(monkeypatch):
    """Texts are counted some at a time, with the counts that all of them at once would have."""
    import tracemalloc

    texts = ["", "", "one two two", *(f"Word {k * k} \u00e9{k % 7}, and {k}! {k}\n" * 40 for k in range(900)), "", "a", "", "word " * 60_000, "", "b b"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])
    assert len(data) > 1_000_000
    tracemalloc.start()
    got = knn_quality.counts(data, offsets)
    used = tracemalloc.get_traced_memory()[1] - got.nbytes
    tracemalloc.stop()
    assert used < 45_000_000  # the longest text's own share; all texts at once take twice that
    monkeypatch.setattr(knn_quality, "_PART_BYTES", 1 << 40)
    assert (got == knn_quality.counts(data, offsets)).all() and not got[[0, 1, 903, 905, 907]].any()


def test_classifier_repeated_rows_and_clashing_column(spark):
    rows = [(k, f"good clean words number {k} " * 9 if k % 2 else f"### $$$ {k} junk ### " * 9) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality_score", F.lit("x"))
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    once = knn_quality.fit(docs, labels)
    again = knn_quality.fit(docs.unionByName(docs), labels.unionByName(labels))
    assert len(once.labels) == len(again.labels) and (once.vectors == again.vectors).all()
    out = knn_quality.score(docs, once)
    assert out.columns == ["doc_id", "text", "quality_score"] and out.schema["quality_score"].dataType.simpleString() == "double"
    assert all((r.quality_score >= 0.5) == (r.doc_id % 2 == 1) for r in out.collect())


def test_counts_do_not_cross_texts():
    def one(texts):
        raw = [t.encode() for t in texts]
        return knn_quality.counts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    texts = ["ab cd", "", " x", "yz yz yz", "é!! A1", " "]
    together = one(texts)
    for k, t in enumerate(texts):
        assert np.array_equal(together[k], one([t])[0]), t


@pytest.fixture(scope="module")
def staged(spark):
    import corpus_pipeline

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0)], docs.schema)
    out = [docs.unionByName(extra)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], "/root/testdata/sf0.001"), "staged"))
    return out


def test_pipeline_columns_and_rows(staged):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs, quality, lines, copies, mixed, packed = staged
    assert all(x.columns == columns for x in (quality, lines, copies, mixed))
    assert lines.count() == quality.count() > copies.count() > mixed.count() > 0


def test_pipeline_near_copies_keep_smallest(staged):
    from editflow.llm import ngram_join

    lines, copies = staged[2], staged[3]
    want = {r["doc_id"] for r in ngram_join.link(lines).collect() if r["doc_id"] is None or r["doc_id"] == r["component_id"]}
    assert {r["doc_id"] for r in copies.collect()} == want


def test_pipeline_mix_takes_its_share(staged):
    from editflow.llm.mixing import count_words

    copies, mixed = staged[3], staged[4]
    total = copies.agg(F.sum(count_words(F.col("text")))).first()[0]
    taken = mixed.agg(F.sum(count_words(F.col("text")))).first()[0]
    assert taken == int(total * 0.8)


def test_pipeline_packs_every_document(staged):
    mixed, packed = staged[4], staged[5]
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in mixed.collect()}

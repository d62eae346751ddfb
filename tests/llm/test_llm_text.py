"""Text operators on small hostile tables, against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from editflow.llm import divergence, html_text, license_scan, line_dedup, mixing, ngram_join, packing, run_index
from editflow.llm.common import saved
from editflow.llm.queries import vocabulary

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Extra columns whose names the operators use inside.
CLASHES = ["text_id", "n_lines", "pos", "h1", "key", "cls", "n", "token", "words", "lines", "list", "spans", "a", "b",
           "anchor", "w", "t", "budget", "tokens", "taken", "label", "node", "root", "host", "order", "uid"]
LINE = "this very line is long enough to be found in every document, ÀÉ"


def _texts():
    rng = random.Random(4)
    vocabulary_ = ["alpha", "Beta", "gamma", "delta", "été", "der", "und", "the", "of", "Straße", "x1", "no", "GPL"]
    base = " ".join(rng.choice(vocabulary_) + str(rng.randrange(60)) for _ in range(160))
    texts = [None, "", "   \n\t ", "one", "one two", base, base, base.replace("alpha", "omega", 2), base.upper(),
             "x " * 30_000, "\n".join([base, LINE, base[:300]]), base + "\r\n" + base]
    texts += [f"{LINE}  \nown line number {k} that is also longer than forty characters\n" for k in range(8)]
    texts += [f"\t{LINE.swapcase().replace('àé', 'ÀÉ')}\nshort" for _ in range(3)]
    texts += [" ".join(rng.choice(vocabulary_) + str(rng.randrange(900)) for _ in range(rng.randrange(3, 90))) for _ in range(25)]
    texts += ["Licensed under CC BY-NC 4.0. mit license MIT License", "the GNU General Public License, version 3",
              "Released under the MIT license", "<|endoftext|> a  b c   d"]
    return texts


ROWS = [(k if k % 13 else k + 1 if k else 0, t, [None, "en", "de", "xx"][k % 4], [None, "s1", "s1", "s2"][k % 4], 5)
        for k, t in enumerate(_texts())]
ROWS += [ROWS[5], (None, ROWS[5][1], "en", "s1", 5), (None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return saved(df.select("*", *(F.lit("extra").alias(c) for c in CLASHES if c not in df.columns)), "docs")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _multiset(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_line_dedup(docs):
    keyed = collections.defaultdict(set)
    def key(line):
        return line.strip(SPACE).translate(LOWER)
    for d, t, *_ in ROWS:
        if d is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 40:
                    keyed[key(line)].add(d)
    want = collections.Counter()
    for d, t, *_ in ROWS:
        lines = (t or "").split("\n")
        gone = [d is not None and len(keyed.get(key(x), ())) >= 5 and max(keyed[key(x)]) != d for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        want[(d, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    out = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = _multiset(out.select("doc_id", "kept_n_lines", "kept_n_dropped", F.sha2(
        F.coalesce("text", F.lit("")).cast("binary"), 256).alias("s")), "doc_id", "kept_n_lines", "kept_n_dropped", "s")
    assert got == want
    assert any(k[2] for k in want)


def test_line_stream_hot_key_over_partitions(spark):
    # One line in every document, ranges far smaller than the key's rows.
    n = 400
    rows = [(k, LINE + "\nown " + str(k)) for k in range(n)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r["doc_id"] for r in out.collect()} == set(range(n - 1))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _sets():
    out = []
    for d, t, *_ in ROWS:
        w = WORD.findall((t or "").translate(LOWER))
        out.append((d, frozenset(tuple(w[k:k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])))
    return out


def test_ngram_join_of_many_near_copies(spark):
    """Index rows follow the tokens, however many copies hold them: no pairs of all prefix tokens."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(4000)}" for _ in range(1200)]
    rows = []
    for k in range(1500):
        words = list(base)
        for _ in range(5):
            words[rng.randrange(len(words))] = f"v{rng.randrange(50)}"
        rows.append((k, " ".join(words)))
    rows += [(2000 + k, " ".join(f"u{rng.randrange(300)}" for _ in range(40)) + " " + " ".join(base[:12])) for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in ngram_join.link(table).collect()}
    assert got == {d: 0 if d < 2000 else d for d, _ in rows}


@pytest.mark.parametrize("frequent", [1, 200, None])
def test_ngram_join(docs, frequent):
    sets = _sets()
    parent = {d: d for d, _ in sets if d is not None}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (d, s) in enumerate(sets):
        for e, r in sets[:i]:
            if d is not None and e is not None and s and r and 100 * len(s & r) >= 85 * len(s | r):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    want = collections.Counter((d, len(s), None if d is None else find(d) if s else d) for d, s in sets)
    got = _multiset(ngram_join.link(docs, frequent=frequent), "doc_id", "n_shingles", "component_id")
    assert got == want


@pytest.mark.parametrize("length,many", [(400, 2048), (40, 2), (40, 2048)])
def test_run_index(docs, length, many):
    raws = [(d, (t or "").encode()) for d, t, *_ in ROWS]
    seen = collections.Counter(b[k:k + length] for _, b in raws for k in range(len(b) - length + 1))
    want = collections.Counter()
    for d, b in raws:
        gone = bytearray(len(b))
        upto = 0
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                for j in range(max(k, upto), k + length):
                    gone[j] = 1
                upto = k + length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        want[(d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    out = run_index.remove(docs, run_index.repeated_spans(docs, length, many=many))
    assert _multiset(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer
    import numpy as np
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    capacity = 64
    cut = saved(packing.pieces(docs, *vocabulary(), capacity=capacity), "pieces")
    rows = packing.pack(cut, capacity, shard_items=50).collect()
    want = collections.Counter()
    for d, t, *_ in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], dtype="<u4").tobytes()))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and p[0][0] == 0 and sum(p[-1]) <= capacity
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // capacity) * 1.05 + 1


def test_special_tokens_as_default_tokenizer():
    from tokenizers import Tokenizer
    import numpy as np
    import public_tokenizers

    from editflow.llm.queries import SPECIALS
    from editflow.llm.tokens import ChunkEncoder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [t or "" for _, t, *_ in ROWS] + [end, f"a b{end}c d", f"x  {end}{end} y\n{end}", f"<|endoftext{end}|>", f"\t{end} "]
    got = ChunkEncoder(*vocabulary(), specials=SPECIALS).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_queries_and_pipeline_find_special_tokens(spark, tmp_path):
    import corpus_pipeline
    from editflow.llm.queries import QUERIES

    rows = [(1, "one<|endoftext|>two", "en", "s", 19)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (QUERIES["op8_genetic_packing"](spark, str(tmp_path)), corpus_pipeline.sequences(spark, docs, str(tmp_path))):
        assert [r["length"] for r in out.collect()] == [4]


def test_evolve_never_gets_worse():
    rng = random.Random(2)
    sizes = [rng.randrange(1, 100) for _ in range(300)]
    first = packing._best_fit(sorted(range(300), key=lambda i: -sizes[i]), sizes, 128)
    best = packing.evolve(sizes, 128, 3, [])[0]
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(sizes[i] for i in b) <= 128 for b in best)
    assert len(best) <= len(first)


def test_mixing_budgets_and_prefix(docs):
    rows = docs.withColumn("domain", F.lit("d"))
    weights = {"lang": {"en": 3, "de": 0}}
    out = mixing.select(rows, ["domain", "lang", "source"], weights, F.col("corpus"), max_epochs=2, slice_rows=2)
    taken = out.collect()
    count = collections.Counter()
    for d, t, lang, source, _ in ROWS:
        count[(lang or "", source or "")] += len(WORD.findall(t or ""))
    got = collections.Counter()
    for r in taken:
        got[(r["lang"], r["source"])] += r["taken"]
        assert 0 < r["taken"] <= r["n_tokens"]
    room = sum(2 * v for (lang, _), v in count.items() if lang != "de")
    assert sum(got.values()) == min(sum(count.values()), room)
    assert all(got[k] <= 2 * count[k] for k in got) and not any(k[0] == "de" for k in got)
    # every epoch below the last is whole
    for leaf in got:
        epochs = [r["epoch"] for r in taken if (r["lang"], r["source"]) == leaf]
        for e in range(max(epochs)):
            assert sum(r["taken"] for r in taken if (r["lang"], r["source"]) == leaf and r["epoch"] == e) == count[leaf]


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\tc d ", 3), ("x", 1)], "text string, n int")
    assert [r[0] for r in df.select(mixing.first_words(F.col("text"), F.col("n"))).collect()] == ["a  b\tc", "x"]


def test_license_scan(docs):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = collections.Counter()
    for d, t, *_ in ROWS:
        w = word.findall((t or "").translate(LOWER))
        found = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        labels = {x for _, x in found}
        share = 0.0
        for block in re.split(r"\n[\x20\x09-\x0D]*\n", t or ""):
            have = set(word.findall(block.translate(LOWER)))
            for label, text, own in license_scan.TEMPLATES:
                need = set(text.split())
                if len(have & need) >= 0.8 * len(need) - 1e-9 and set(own.split()) <= have:
                    labels.add(label)
                    share = max(share, len(have & need) / len(need))
        at = [k for k, _ in found]
        want[(d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})),
              ",".join(sorted(labels)), 1.0 if at else share)] += 1
    got = _multiset(license_scan.scan(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert got == want


@pytest.mark.parametrize("text,labels", [
    ("Released under the Apache License", "apache"),
    ("Distributed under the license it was released under", ""),
    ("Released under the MIT License", "mit,mit-notice"),
    ("intro\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
     "documentation files (the \"Software\"), to deal\nin the Software without restriction, including\n\nmore", "mit-notice"),
    ("* Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the\n"
     " * following conditions are met:", "bsd"),
    ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License "
     "as published by\n# the Free Software Foundation", "gpl,gpl-3.0"),
    ("Permission is hereby granted, free of charge, to any person\n \t\nobtaining a copy of this software", ""),
    ("Released under the MIT li\u212aense", ""),
])
def test_license_labels(spark, text, labels):
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r.labels for r in license_scan.scan(rows).collect()] == [labels]


def test_divergence_base_figures(docs):
    want = collections.Counter()
    for d, t, *_ in ROWS:
        w = WORD.findall(t or "")
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        n = collections.Counter(grams)
        cover = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want[(d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover),
              len(w) < 50 or 100 * len(cover) > 50 * len(w))] += 1
    out = divergence.judge(docs)
    assert _multiset(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    assert out.where("base_failed AND kept").count() == 0


def test_js_distance(spark):
    df = spark.createDataFrame([([1, 1], [1, 1]), ([1, 0], [0, 1]), ([0, 0], [1, 1])], "p array<long>, q array<long>")
    got = [r[0] for r in df.select(divergence.js_distance(F.col("p"), F.col("q"))).collect()]
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1) and got[2] is None


def _page(body, host="h.example"):
    return f"<html><head><title>t</title></head><body><nav><a>menu</a></nav>{body}<footer>foot</footer></body></html>"


def test_html_structure():
    cases = {
        "": "", "plain &lt;b&gt; &amp;amp; text": "plain <b> &amp; text",
        _page('<article><h1>T</h1><p>a <b>b</b>c<br>d</article><div>out</div>'): "T a bc d",
        _page('<article>a<section class="comments">no</section><p>b<script>var x="</p>";</script></article>'): "a b",
        '<div class="cookie-notice">x<div>y</div></div><p>z': "z",
        "a<!-- > -->b<!-- open": "ab", "1 < 2 <br> 3": "1 < 2 3",
        '<p class=ad>x<p>y': "y", "<div hidden>x</div>y <img alt='a>b'> z": "y z",
    }
    for page, text in cases.items():
        assert " ".join(html_text.blocks(page)[0]) == text, page


@pytest.mark.parametrize("element", [
    '<div class="main-menu">', '<div id="page-header">', '<div class="post-comments">', '<div class="content-sidebar">',
    '<div class="story-newsletter">', '<article><div class="entry-comments">', '<article><footer class="post-footer">',
    '<div class="commentList">', '<section id="cookie_notice">'])
def test_html_furniture_by_its_last_word(element):
    page = f"<body>{element}not this</div></footer></section></article><div class='main-text has-sidebar'>this stays</div></body>"
    text = " ".join(html_text.blocks(page)[0])
    assert "not this" not in text and ("this stays" in text or element.startswith("<article>"))


@pytest.mark.parametrize("element", [
    '<div class="post-content">', '<div class="menu-content">', '<div id="main-article">', '<div class="entry-header">',
    '<article><div class="post-header">', '<div class="with-nav">', '<div class="page no-sidebar">'])
def test_html_content_by_its_last_word(element):
    assert html_text.blocks(f"<body>{element}stays</div></article></body>")[0] == ["stays"]


def test_html_raw_elements_without_end():
    cases = {
        '<p>a <svg class="x"/> b <math/> c': "a b c", "a<svg/>b<svg><path/>no</svg>c": "a b c",
        "a<noscript>b <p>c": "a b c", "<object>a": "a", "<video src=x>a": "a", "<canvas>a": "a",
        "a<script>no <p>no": "a", "a<style>no": "a", "a<textarea>no": "a",
    }
    for page, text in cases.items():
        assert " ".join(html_text.blocks(page)[0]) == text, page


def test_html_boilerplate(spark):
    notice = "we use little files to remember what you read here and there all day long"
    rows = [(k, f"https://h.example/{k}", f"<div>{notice}</div><p>{k} page has words of its own {k * k} and more {k + 7}") for k in range(20)]
    rows += [(100, None, None), (101, "https://e.example", ""), (102, "https://h.example/x", _page("<article>only one</article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("c"))
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert len(got) == len(rows)
    assert got[3] == "3 page has words of its own 9 and more 10"
    assert got[100] == "" and got[101] == "" and got[102] == "only one"


def _own(k, n):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_html_counts_over_the_whole_host(spark):
    """Boilerplate on few pages of each chunk, and the same texts whatever the chunks."""
    notice = " ".join(f"notice{i}" for i in range(14))
    rows = [(k, f"https://h.example/{k}", f"<p>{_own(k, 40)}</p>" + (f"<div>{notice}</div>" if k % 10 == 0 else "")) for k in range(200)]
    rows += [(k, f"https://h.example/{k}", f"<article><p>{_own(k, 40)}</p>" + (f"<div>{notice}</div>" if k % 10 == 0 else "") + "</article>")
             for k in range(200, 300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {k: _own(k, 40) for k in range(300)}
    for chunk, partitions in ((512, 1), (16, 7)):
        out = html_text.extract(df.repartition(partitions, "page_id"), chunk_pages=chunk)
        assert {r["page_id"]: r["text"] for r in out.collect()} == want


def test_html_near_copies_stay(spark):
    """Three near copies of an article on a plain host keep it; copies count as one page."""
    article = _own("a", 200)
    rows = [(k, f"https://h.example/{k}", f"<p>{article} end{k}</p>") for k in range(3)]
    rows += [(k, f"https://c.example/{k}", f"<p>{article}</p>") for k in range(3, 30)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"{article} end{k}" if k < 3 else article for k in range(30)}


def test_empty_tables(spark, empty, docs):
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    assert ngram_join.link(empty).count() == 0
    assert run_index.remove(empty, run_index.repeated_spans(empty)).count() == 0
    assert packing.pack(saved(packing.pieces(empty, *vocabulary()), "pieces")).count() == 0
    assert mixing.select(empty, ["lang", "source"], {}, F.col("corpus")).count() == 0
    assert license_scan.scan(empty).count() == 0
    assert divergence.judge(empty).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_token_chunks_with_any_white_space():
    """Ids of texts with blank lines, tabs and other white space, within the cache's bytes."""
    from tokenizers import Tokenizer
    import public_tokenizers

    from editflow.llm.tokens import ChunkEncoder

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = ChunkEncoder(*vocabulary(), max_bytes=200_000)
    rng = random.Random(9)
    parts = ["word", "it's", "über", "42", "!?", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", " \n ", "\x0b", "\x0c", "\u00a0", "\u3000",
             "\x1c", "\x85", "\u200b", "x" * 90, "日本", "'ll"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    texts += [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) + "\n\nend " * 3 for _ in range(2000)]
    for k in range(0, len(texts), 500):
        some = texts[k:k + 500]
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert list(memoryview(ids).cast("I")) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert encoder.held_bytes <= encoder.max_bytes + 25_000_000
    for held in (encoder.young, encoder.old):
        assert all(len(c) <= 64 for c in held)
    assert sum(map(len, encoder.young)) + sum(map(len, encoder.old)) < 2_000_000


def test_distinct_words_are_encoded_in_one_call():
    """Chunks are those of the pattern's rule, and a group's distinct words cost one call of the encoder."""
    import re

    import numpy as np

    from editflow.llm.tokens import ChunkEncoder, chunk_starts

    chunk = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]")
    rng = random.Random(4)
    texts = ["".join(rng.choice([" ", " ", "\t", "\n", "a", "bé", "zz"]) for _ in range(rng.randrange(9))) for _ in range(2000)]
    raw = [t.encode() for t in texts]
    starts = chunk_starts(np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
    cuts = [*starts.tolist(), sum(map(len, raw))]
    assert [b"".join(raw)[a:b].decode() for a, b in zip(cuts, cuts[1:])] == [c for t in texts for c in chunk.findall(t)]

    encoder, calls = ChunkEncoder(*vocabulary()), []
    one = encoder.one
    encoder.one = lambda text: calls.append(text) or one(text)
    texts = [" ".join(f"word{k * j}" for j in range(30)) for k in range(500)]
    got = encoder.encode(texts)
    assert len(calls) == 1
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in got] == [one(t) for t in texts]
    assert encoder.encode([]) == [] and encoder.encode(["", " "]) == [b"", np.array(one(" "), dtype="<u4").tobytes()]


def test_page_words_are_hashed_by_whole_arrays():
    """Each page's hashes in order, 0 after each block; equal words are hashed once; blocks survive packing."""
    rng = random.Random(5)
    pages = [[" ".join(rng.choice(["a", "bé", "c", "日本", "dd"]) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(4))]
             for _ in range(200)]
    hashes = html_text._Hashes(3)
    texts = [html_text.lines(html_text.packed(p)) for p in pages]
    assert [t.decode().split("\n") if t else [] for t in texts] == pages
    want = [[h for b in p for h in [*(hashes.word(w.encode()) for w in b.split(" ")), 0]] for p in pages]
    assert [codes.tolist() for codes in hashes.pages(texts)] == want
    assert len(hashes.known) == 5 and hashes.pages([]) == [] and hashes.pages([b""])[0].tolist() == []


def test_page_words_take_no_call_each(monkeypatch):
    """Words of any length are hashed without a call for each, whatever stands beside them; runs of many pages at once."""
    import numpy as np

    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abé\x00") for _ in range(n)) for n in (*range(1, 40), 64, 65, 200) for _ in range(6)})
    hashes = html_text._Hashes(3)
    alone = {w: hashes.word(w.encode()) for w in words}
    assert len(set(alone.values())) == len(words)
    pages = [[rng.choice(words) for _ in range(rng.randrange(9))] for _ in range(100)]
    hosts = [rng.choice(["", "a.example"]) for _ in pages]
    whole = [np.array([h for w in p for h in (alone[w], 0)], dtype=np.uint64) for p in pages]
    want = [hashes.runs([codes], [host])[0].tolist() for codes, host in zip(whole, hosts)]
    assert [len(r) for r in want] == [max(0, 2 * len(p) - 2) for p in pages]
    assert [r.tolist() for r in hashes.runs(whole, hosts)] == want
    monkeypatch.setattr(hashes, "word", None)
    assert [c.tolist() for c in hashes.pages(["\n".join(p).encode() for p in pages])] == [c.tolist() for c in whole]


def test_components_write_few_files(spark, monkeypatch):
    """The rounds' tables have no more files than the cluster has cores, however many partitions a shuffle has."""
    from editflow.llm import components as C

    written, save = [], C.saved

    def counted(df, name):
        out = save(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(C, "saved", counted)
    cores = spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(8 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        links = spark.range(600).selectExpr("id * 10 as a", "(id + if(id % 6 = 5, 0, 1)) * 10 as b")
        got = {r["node"]: r["root"] for r in C.components(links).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {10 * k: 10 * (k - k % 6) for k in range(600)}
    assert all(n <= cores for name, n in written if name != "edges"), written

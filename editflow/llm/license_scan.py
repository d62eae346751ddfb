"""License scan: phrase places, and an exact set-similarity join of text blocks with templates.

Words are maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lowered. A
text is kept as one string in which each word stands between two spaces of its own, so that a
phrase is a plain substring and phrase places never share a character.

The join finds every block (paragraph: lines up to a blank one, so that a wrapped notice is whole)
that holds at least ``threshold`` of a template's distinct words and all words that tell the template
from other notices. Template words are ordered by the number of documents that hold them, rarest first. A
block that holds ``alpha`` of a template's ``n`` words must hold one of its ``n - alpha + 1``
rarest (prefix filter); it needs ``alpha`` template words at all (length filter), and the words
that are left after the shared one must suffice (positional filter). What passes is verified by
the exact intersection. Only template words enter the join, and the templates are a fixed
parameter: they and the index over their prefixes are the bounded, broadcast side.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import own_columns, saved, text_id

# Phrases and labels of the contract.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Templates of the set join: label, wording as public licence notices state it, and the words that tell
# it from other notices: without them no share of the rest suffices.
TEMPLATES = (
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache 2"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file "
                   "except in compliance with the license", "apache compliance"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met", "redistribution source binary modification"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu public 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the "
                "gnu general public license as published by the free software foundation", "gnu redistribute modify"),
    ("mit-notice", "released under the mit license", "mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software "
                   "and associated documentation files to deal in the software without restriction",
     "permission granted charge software"),
)
# Fixed value: the end of a block, at least one blank line.
BLOCK_BREAK = "\\n[\\x20\\x09-\\x0D]*\\n"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def spaced(text: Column) -> Column:
    """`` w1  w2  w3 ``; empty for null and for texts without a word."""
    inner = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK, "  "))
    return F.when(inner == "", "").otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _words(spaced_text: Column) -> Column:
    return F.split(F.trim(spaced_text), "  ", -1)


def _count(s: Column, part: str) -> Column:
    return (F.length(s) - F.length(F.replace(s, F.lit(part)))) / F.lit(len(part))


def _words_before(s: Column, place: Column) -> Column:
    before = F.substring(s, F.lit(1), place - 1)
    return ((F.length(before) - F.length(F.replace(before, F.lit(" ")))) / 2).cast("long")


def phrase_places(docs: DataFrame, text_col: str = "text", phrases: dict[str, str] = PHRASES) -> DataFrame:
    """``docs`` plus ``n_words, n_base, first_word, last_word, base_found`` (array of labels)."""
    s = F.col("__spaced")
    parts = {" " + "  ".join(p.split(" ")) + " ": label for p, label in phrases.items()}
    counts = [_count(s, p).cast("long") for p in parts]
    out = docs.withColumn("__spaced", spaced(docs[text_col]))
    out = out.withColumns({
        "n_words": _count(s, " ").cast("long"),
        "__counts": F.array(*counts),
    })
    out = out.withColumn("n_words", F.floor(F.col("n_words") / 2).cast("long"))
    firsts, lasts, found = [], [], []
    for k, (p, label) in enumerate(parts.items()):
        here = F.get("__counts", F.lit(k)) > 0
        firsts.append(F.when(here, _words_before(s, F.instr(s, p))))
        back = F.instr(F.reverse(s), p[::-1])
        lasts.append(F.when(here, _words_before(s, F.length(s) - back - (len(p) - 2))))
        found.append(F.when(here, F.lit(label)))
    return out.withColumns({
        "n_base": F.aggregate("__counts", F.lit(0).cast("long"), lambda a, x: a + x),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "base_found": F.array_compact(F.array(*found)),
    }).drop("__spaced", "__counts")


def _alpha(n: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * n, 9)))


def template_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, block_break: str = BLOCK_BREAK) -> DataFrame:
    """Every (document, label) with a block that holds enough of a template: ``doc_id, text_id, label, share``.

    ``templates`` are (label, wording, own words); a template's own words all have to be in the block.
    ``docs`` has ``doc_id`` and ``text``. ``share`` is the largest containment found. Rows that
    share id and text are one document here.
    """
    spark = docs.sparkSession
    sets = [(label, sorted(set(text.split(" "))), own.split(" ")) for label, text, own in templates]
    vocabulary = sorted({w for _, words, _ in sets for w in words})
    literal = F.array(*map(F.lit, vocabulary))
    blocks = docs.select(
        "doc_id", text_id(F.col("text")).alias("text_id"),
        F.explode(F.split(F.coalesce("text", F.lit("")), block_break, -1)).alias("block"))
    least = min(_alpha(len(words), threshold) for _, words, _ in sets)
    held = (
        blocks.select("doc_id", "text_id", F.array_intersect(literal, _words(spaced(F.col("block")))).alias("held"))
        .where(F.size("held") >= least)
    )
    # Only blocks with enough template words; document frequency over all of them.
    held = saved(held, "license-blocks")
    frequency = {r["w"]: r["n"] for r in held.select(F.explode("held").alias("w")).groupBy("w").agg(
        F.count("*").alias("n")).collect()}  # at most one row per template word
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}

    index = []
    for t, (_, words, _) in enumerate(sets):
        ordered = sorted(words, key=rank.__getitem__)
        alpha = _alpha(len(words), threshold)
        index += [(ordered[i], t, i, alpha) for i in range(len(words) - alpha + 1)]
    prefixes = F.broadcast(spark.createDataFrame(index, "w string, t int, i int, alpha int"))
    catalogue = F.broadcast(spark.createDataFrame(
        [(t, label, words, own) for t, (label, words, own) in enumerate(sets)],
        "t int, label string, words array<string>, own array<string>"))
    ranked = F.array(*map(F.lit, sorted(vocabulary, key=rank.__getitem__)))
    ordered = held.select("doc_id", "text_id", F.array_intersect(ranked, F.col("held")).alias("b"))
    size = F.size("b")
    shared = ordered.select("*", F.posexplode("b").alias("j", "w")).join(prefixes, "w")
    template_size = F.size("words")
    candidates = (
        shared.where(size >= F.col("alpha"))
        .join(catalogue, "t")
        .where(F.least("i", "j") + 1 + F.least(template_size - 1 - F.col("i"), size - 1 - F.col("j")) >= F.col("alpha"))
        .withColumn("common", F.size(F.array_intersect("b", "words")))
        .where("common >= alpha").where(F.size(F.array_except("own", "b")) == 0)
    )
    return candidates.groupBy("doc_id", "text_id", "label").agg(
        F.max(F.col("common") / template_size).alias("share"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 where a phrase was found, else the largest template containment found, else
    0. Null and empty texts have no words and no labels; a null id is kept.
    """
    rows = own_columns(docs, doc_id=id_col, text=text_col)
    base = phrase_places(rows).select(
        "doc_id", text_id(F.col("text")).alias("text_id"), "n_words", "n_base", "first_word", "last_word", "base_found")
    found = (
        template_matches(rows, templates, threshold)
        .groupBy("doc_id", "text_id")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
        .select(F.col("doc_id").alias("m_doc"), F.col("text_id").alias("m_tid"), "more", "share")
    )
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("m_doc")) & (F.col("text_id") == F.col("m_tid")), "left")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return both.select(
        F.col("doc_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        joined(F.col("base_found")).alias("base_labels"),
        joined(F.concat("base_found", F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).cast("double").alias("score"),
    )

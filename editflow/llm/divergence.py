"""Quality rules by distribution divergence: Jensen-Shannon distances to language references.

Per document, one pass counts the words and the rule figures, a histogram over character
classes and one over the common words of its language. The references are the summed
histograms of all documents of a language that pass the base rules. A document is kept unless
a base rule fails or a distance that it is long enough for passes its limit.

DataFrame functions only; a document is never exploded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.llm.common import SPACE_CLASS, own_columns, saved

# Frequent function words by language.
COMMON_WORDS = {
    "de": ["auf", "dem", "den", "der", "des", "die", "ein", "für", "ist", "mit", "und", "von", "zu"],
    "en": ["a", "and", "as", "by", "in", "is", "of", "on", "that", "the", "this", "to", "with"],
    "es": ["con", "de", "del", "el", "en", "es", "la", "las", "los", "para", "por", "que", "una"],
    "fr": ["avec", "dans", "de", "des", "en", "est", "et", "la", "le", "les", "pour", "que", "une"],
}
# Character classes as complements of a pattern; what none holds (non-ASCII) is the last class.
_CLASSES = ("a-z", "A-Z", "0-9", SPACE_CLASS, ".,;:!?'\"()\\-", "#*$%&|<>@^~_=+/{}\\[\\]\\\\`")
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _length_of(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows (hashes in text order) that occur at least twice."""
    by_hash = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    again = _let(by_hash, lambda s: F.filter(s, lambda e, k: F.coalesce(
        (e["g"] == F.get(s, k - 1)["g"]) | (e["g"] == F.get(s, k + 1)["g"]),
        F.coalesce(e["g"] == F.get(s, k - 1)["g"], e["g"] == F.get(s, k + 1)["g"]), F.lit(False))))
    starts = F.array_sort(F.transform(again, lambda e: e["i"]))
    steps = _let(starts, lambda p: F.transform(
        p, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts per row: the rule figures, ``chars`` and ``commons`` (histograms as arrays of long).

    Null and empty texts have no words, no lines with words and empty histograms. Languages
    without a word list use none; a null language is the value ``''``.
    """
    rows = own_columns(docs, doc_id=id_col, text=text_col, lang=lang_col)
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), text.alias("text"))
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{SPACE_CLASS}]+", -1)))
    n = F.size("words")
    lists = [x for lang, words in COMMON_WORDS.items() for x in (F.lit(lang), F.array(*map(F.lit, words)))]
    rows = rows.withColumns({
        "grams": F.when(n >= 3, F.zip_with(
            F.zip_with(F.slice("words", F.lit(1), n - 2), F.slice("words", F.lit(2), n - 2), lambda v, w: F.xxhash64(v, w)),
            F.slice("words", F.lit(3), n - 2), lambda g, w: F.xxhash64(g, w))),
        "list": F.coalesce(F.try_element_at(F.create_map(*lists), F.col("lang")), F.array().cast("array<string>")),
        "lines": F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""),
    })
    # Bound by _let: as a column of its own it would be inlined, and filtered anew for each listed word.
    common = F.filter("words", lambda w: F.array_contains(F.col("list"), w))
    commons = _let(common, lambda c: F.transform(
        F.col("list"), lambda w: F.size(F.filter(c, lambda x: x == w)).cast("long")))
    classes = [_length_of(F.col("text"), c) for c in _CLASSES]
    out = rows.select(
        "doc_id", "lang", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _length_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # Most texts repeat no window; only the others are sorted.
        F.when(F.col("grams").isNull() | (F.size(F.array_distinct("grams")) == F.size("grams")), 0)
        .otherwise(_repeat_words(F.col("grams"))).cast("long").alias("n_repeat_words"),
        F.array(*classes).alias("chars"), F.length("text").cast("long").alias("n_chars"),
        commons.alias("commons"),
    )
    return out.withColumns({
        "chars": F.concat("chars", F.array(F.col("n_chars") - F.aggregate(
            "chars", F.lit(0).cast("long"), lambda a, x: a + x))),
        "commons": F.concat("commons", F.array(F.col("n_words") - F.aggregate(
            "commons", F.lit(0).cast("long"), lambda a, x: a + x))),
        "base_failed": F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"),
    })


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two count histograms; null if one is empty."""
    total = lambda h: F.aggregate(h, F.lit(0.0), lambda a, x: a + x.cast("double"))

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    def body(sums: Column) -> Column:
        terms = F.zip_with(p, q, lambda x, y: _let(
            F.struct((x / sums["p"]).alias("a"), (y / sums["q"]).alias("b")),
            lambda s: (part(s["a"], s["b"]) + part(s["b"], s["a"])) / 2))
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))

    sums = F.struct(total(p).alias("p"), total(q).alias("q"))
    return _let(sums, lambda s: F.when((s["p"] > 0) & (s["q"] > 0), body(s)))


def references(feats: DataFrame) -> DataFrame:
    """Summed histograms by language over the documents that pass the base rules (two long arrays)."""
    widest = max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(F.get("chars", F.lit(k))).alias(f"c{k}") for k in range(len(_CLASSES) + 1)]
    sums += [F.sum(F.get("commons", F.lit(k))).alias(f"w{k}") for k in range(widest)]
    summed = feats.where("not base_failed").groupBy("lang").agg(*sums)
    return summed.select(
        F.col("lang").alias("ref_lang"),
        F.array(*(f"c{k}" for k in range(len(_CLASSES) + 1))).alias("ref_chars"),
        F.array_compact(F.array(*(f"w{k}" for k in range(widest)))).alias("ref_commons"))


def judge(docs: DataFrame, max_char_distance: float = 0.32, max_word_distance: float = 0.36,
          min_chars: int = 200, min_words: int = 50,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: the rule figures, both distances, ``base_failed`` and ``kept``.

    A distance counts only from ``min_chars`` characters (``min_words`` words) on; a missing
    distance (no reference for the language, no word list) rejects nothing.
    """
    feats = saved(features(docs, id_col, text_col, lang_col), "divergence-features")
    refs = references(feats)
    x = feats.join(refs, feats["lang"] == refs["ref_lang"], "left")
    has_list = F.size("commons") > 1
    x = x.withColumns({
        "char_distance": F.when(F.col("n_chars") >= min_chars, js_distance(F.col("chars"), F.col("ref_chars"))),
        "word_distance": F.when((F.col("n_words") >= min_words) & has_list,
                                js_distance(F.col("commons"), F.col("ref_commons"))),
    })
    far = F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > max_word_distance, F.lit(False))
    return x.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")

"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame that the caller writes as Parquet and gives to the next one as ``docs``. All stages
but the last return the columns of ``documents``; whatever a stage decides takes effect in what
it returns. Labels and vocabularies are looked up beside the documents (``sf_dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.llm import knn_quality, line_dedup, mixing, ngram_join, packing
from editflow.llm.common import saved, table, text_id
from editflow.llm.queries import MIX_LEVELS, MIX_WEIGHTS, SPECIALS, domain, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_FLOOR = 0.3
# Share of the tokens that the mix takes. Each document is read at most once, so the share is
# what the weights can act on: at 1 every document would be taken whatever they say.
MIX_SHARE = 0.8
CAPACITY = 2048
BROADCAST_ROWS = 1_000_000  # 16 bytes a row: a checked bound; beyond it the join shuffles


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; texts without features get the labels' average."""
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = knn_quality.score(docs.select(*COLUMNS), model)
    return scored.where(F.col("quality_score") >= QUALITY_FLOOR).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the long lines that at least five documents hold (the last one keeps them)."""
    kept = line_dedup.apply_bitmaps(docs.select(*COLUMNS), line_dedup.keep_bitmaps(docs))
    n_chars = F.when(F.col("kept_n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest id, once if it is repeated.

    Texts without words are linked with nothing and stay.
    """
    links = saved(ngram_join.link(docs), "stage-links")
    gone = saved(links.where("component_id <> doc_id").select("doc_id").distinct(), "stage-gone")
    repeated = saved(links.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
                     .select("doc_id"), "stage-repeated")

    def bounded(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids

    kept = docs.select(*COLUMNS).join(bounded(gone), "doc_id", "left_anti")
    once = kept.join(bounded(repeated), "doc_id", "left_semi").withColumn("t", text_id(F.col("text"))).dropDuplicates(
        ["doc_id", "t"])
    return kept.join(bounded(repeated), "doc_id", "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, each at most once; the last of a leaf is cut to its budget."""
    rows = docs.select(*COLUMNS).withColumn("domain", domain())
    taken = mixing.select(rows, MIX_LEVELS, MIX_WEIGHTS, F.floor(F.col("corpus") * MIX_SHARE), max_epochs=1, seed=1)
    taken = taken.select("doc_id", F.col("text_id").alias("t"), "n_tokens", "taken").dropDuplicates(["doc_id", "t"])
    x = docs.select(*COLUMNS, text_id(F.col("text")).alias("tid"))
    x = x.join(taken.withColumnRenamed("doc_id", "m"), F.col("doc_id").eqNullSafe(F.col("m")) & (F.col("tid") == F.col("t")))
    cut = F.col("taken") < F.col("n_tokens")
    text = F.when(cut, mixing.first_words(F.col("text"), F.col("taken"))).otherwise(F.col("text"))
    return x.withColumn("text", text).withColumn(
        "n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's pieces with their place in sequences of at most ``CAPACITY`` tokens."""
    cut = saved(packing.pieces(docs, *vocabulary(), capacity=CAPACITY, specials=SPECIALS), "pack-pieces")
    return packing.pack(cut, CAPACITY).drop("uid")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mix),
    ("best-fit packing", sequences),
]

# SQL can express neither the classifier's model nor the genetic packing; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

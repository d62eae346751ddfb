"""Shared helpers: written intermediate tables, row identity, ASCII word pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.session import scratch_path

# ASCII white space and a word between it, as every contract here uses them.
SPACE_CLASS = "\\x20\\x09-\\x0D"
ASCII_SPACE = " \t\n\x0b\x0c\r"

TABLE = "{}/{}.parquet"
ROWS_A_FILE = 50_000  # small rows that one task writes at least, if there are more tasks than cores


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(TABLE.format(sf_dir.rstrip("/"), name))


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor costs only the reader's own stage, and
    several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` small rows, in as many tasks as the cluster runs at once or its rows ask for.

    A table of a few thousand rows that is written once a round would else be one file for each shuffle
    partition; writing a file costs the executor far more than its few rows, on a local disk new processes too.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE)))


def text_id(text: Column) -> Column:
    """Hash of the text that tells rows with one doc_id apart (null texts share a value)."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def own_columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named input columns under internal names, so that extra columns never clash."""
    return df.select(*(df[source].alias(name) for name, source in wanted.items()))

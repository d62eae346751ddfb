"""Batches that are complete across all of a stream's sinks.

A micro-batch writes its sinks one after another, and each of them is idempotent. The batch counts
only once its marker is there, which is written after the last sink; readers that go through
``read_committed`` see every sink up to the same batch, whatever failed in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from editflow.sources import store

KEEP = 20  # markers that stay; batches commit in order, so the latest one stands for all before


def mark(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Publish batch ``batch_id`` (and with it all before) as complete."""
    store.put(spark, f"{folder}/{int(batch_id):012d}", "")
    for old in store.names(spark, folder)[:-KEEP]:
        store.remove(spark, f"{folder}/{old}")


def last(spark: SparkSession, folder: str) -> int:
    """The latest complete batch, -1 if there is none."""
    marks = store.names(spark, folder)
    return int(marks[-1]) if marks else -1


def read_committed(spark: SparkSession, path: str, folder: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a sink's complete batches; partition pruning leaves the others unread."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).where(F.col("batch_id") <= last(spark, folder))

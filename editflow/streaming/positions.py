"""What a streaming query has committed, read from its own checkpoint, and its state as tables.

A query writes the offsets of each batch before it runs (``offsets/<n>``) and a mark when the batch is
done (``commits/<n>``). The positions of the last marked batch are what it will resume after; a batch
that was planned and failed does not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.sources import store

POSITIONS = "source int, topic string, partition int, committed_offset long"


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the query has completed, -1 if there is none."""
    done = [int(n) for n in store.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(done, default=-1)


def planned_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose offsets were written: one more than the committed one while a batch runs,
    and after a failure."""
    begun = [int(n) for n in store.names(spark, f"{checkpoint}/offsets") if n.isdigit()]
    return max(begun, default=-1)


def _source_offsets(spark: SparkSession, checkpoint: str) -> list[str]:
    """The committed batch's offset of each source, as its JSON (after a version and a metadata line)."""
    batch = committed_batch(spark, checkpoint)
    return store.text(spark, f"{checkpoint}/offsets/{batch}").splitlines()[2:] if batch >= 0 else []


def broker_positions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source, topic, partition, committed_offset) of sources that keep an offset for each partition."""
    rows = spark.createDataFrame(list(enumerate(_source_offsets(spark, checkpoint))), "source int, json string")
    topics = F.from_json("json", "map<string,map<string,bigint>>")
    each = rows.where("json not like '%\"logOffset\"%'").select("source", F.explode(topics).alias("topic", "at"))
    return each.select("source", "topic", F.explode("at").alias("partition", "committed_offset")).withColumn(
        "partition", F.col("partition").cast("int"))


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(path, batch_id) of the files that a file source has read in completed batches.

    The source logs the files of each of its offsets, and now and then all so far in one compact file.
    """
    offsets = _source_offsets(spark, checkpoint)
    log = f"{checkpoint}/sources/{source}"
    if source >= len(offsets) or not store.names(spark, log):
        return spark.createDataFrame([], "path string, batch_id long")
    entry = F.from_json("value", "path string, batchId bigint")
    upto = F.get_json_object(F.lit(offsets[source]), "$.logOffset").cast("long")
    lines = spark.read.text(log).where("value like '{%'").select(entry.alias("e"))
    return lines.where(F.col("e.batchId") <= upto).select(
        F.col("e.path").alias("path"), F.col("e.batchId").alias("batch_id")).distinct()


def _plain(path):
    """A path without the form of its scheme: the log writes ``file:///x``, a scan may say ``file:/x``."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^([a-z0-9]+):/*", "$1:/")


def file_positions(records: DataFrame, checkpoint: str, source: int = 0) -> DataFrame:
    """(topic, partition, committed_offset) of a file topic: the next offset behind the files read.

    ``records`` is the topic as a batch DataFrame (``read_topic``) over its files.
    """
    done = committed_files(records.sparkSession, checkpoint, source).select(_plain("path").alias("_path"))
    placed = records.select("topic", "partition", "offset", _plain(F.col("_metadata.file_path")).alias("_path"))
    return placed.join(done, "_path", "left_semi").groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("committed_offset"))


def state_table(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keyed state of a query's first stateful operator as it was after its last batch: the table
    that the stream keeps, read from the checkpoint and not from a sink."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.*")


def state_changes(spark: SparkSession, checkpoint: str, first: int = 0, last: int | None = None) -> DataFrame:
    """The table's changes by batch: (batch_id, change_type, key columns, value columns)."""
    reader = spark.read.format("statestore").option("readChangeFeed", "true").option("changeStartBatchId", first)
    if last is not None:
        reader = reader.option("changeEndBatchId", last)
    return reader.load(checkpoint).select("batch_id", "change_type", "key.*", "value.*")

"""Topics: a message broker when its connector is on the classpath, JSON files otherwise.

Both give the same columns (``schemas.TOPIC_RECORD``): key, value, topic, partition, offset,
timestamp. A file topic is a folder of JSON-lines files; the streaming file source tracks
which files it has consumed in the query checkpoint, which gives the same resume-after-restart
behaviour as broker offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.schemas import TOPIC_RECORD


def to_records(
    df: DataFrame,
    key: Column,
    value: Column,
    topic: str,
    offset: Column,
    timestamp: Column,
    partition: Column | None = None,
    partitions: int = 4,
) -> DataFrame:
    """Shape rows as topic records. The partition defaults to a hash of the key."""
    part = partition if partition is not None else F.pmod(F.xxhash64(key), F.lit(partitions))
    return df.select(
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )


def write_topic(records: DataFrame, path: str, files: int | None = None) -> str:
    """Append records to a file topic (JSON lines). ``files`` sets how many files (and so how
    many micro-batches with ``maxFilesPerTrigger=1``) a small test topic is cut into."""
    out = records.repartition(files, "partition", "offset") if files else records
    out.write.mode("append").json(path)
    return path


def store_topic(records: DataFrame, path: str) -> str:
    """A topic kept as parquet in order of partition and offset: a reader of some offsets skips the
    other files and row groups by their statistics."""
    order = ["partition", "offset"]
    records.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return path


def read_stored_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_RECORD).parquet(path)


def read_topic(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Read a file topic as a batch or a streaming DataFrame with the fixed record schema."""
    if not stream:
        return spark.read.schema(TOPIC_RECORD).json(path)
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def read_broker_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    stream: bool = True,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A broker topic through Spark's Kafka source (needs the connector package at submit).

    Returns the same columns as a file topic; ``maxOffsetsPerTrigger`` bounds each batch.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting_offsets if stream else "earliest")
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def write_broker_topic(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Write key/value records to a broker topic (batch, or a started streaming query)."""
    out = records.select("key", "value")
    if records.isStreaming:
        return (
            out.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .start()
        )
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None

"""JDBC tables: partitioned reads of the history table and replay-safe appends.

These are Spark's own JDBC reader and writer; the driver jar of the target database must be on
the classpath. The test suite does not start a database (see README), so this module is
exercised only by the plans it builds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a table; with a numeric ``partition_column`` the read is split into
    ``num_partitions`` parallel range queries instead of one connection pulling everything."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=properties,
    )


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> None:
    """Plain append (what a one-shot batch job needs)."""
    df.write.option("batchsize", batch_size).jdbc(url, table, mode="append", properties=properties)


def append_jdbc_once(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    batch_id: int,
    key_columns: list[str],
) -> DataFrame:
    """Append a micro-batch so that a replay of the same batch adds nothing twice.

    Spark's JDBC writer commits per partition, so a batch that failed half-way may be partly
    in the table when it is retried. Rows carry ``batch_id`` and a stable key (for topic input:
    partition and offset); before appending, the keys already stored for this batch are read
    back (a pushed-down ``WHERE batch_id = n``) and removed with a ``left_anti`` join.
    Returns the rows that were appended.
    """
    rows = df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    cols = ", ".join(key_columns)
    stored = read_table_jdbc(
        df.sparkSession, url, f"(SELECT {cols} FROM {table} WHERE batch_id = {int(batch_id)}) stored", properties
    )
    fresh = rows.join(stored, key_columns, "left_anti")
    append_jdbc(fresh, url, table, properties)
    return fresh

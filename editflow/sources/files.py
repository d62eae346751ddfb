"""File tables: the raw edit log, the history CSV, and batch-keyed sink folders.

Sinks write one folder per micro-batch (``batch_id=<n>``) with overwrite, so a batch that is
replayed after a failure replaces its own output instead of appending it twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from editflow.schemas import HISTORY, RAW_TABLE, RAW_TABLE_WITH_BATCH, SCORED, SCORED_WITH_BATCH


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> str:
    """Write one batch's rows to ``path/batch_id=<id>`` (idempotent per batch)."""
    target = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def write_raw_table(edits: DataFrame, path: str, batch_id: int) -> str:
    """Raw edit log: the ten parsed columns in alphabetical order, one folder per batch."""
    return write_batch(edits.select(*[F.col(f.name) for f in RAW_TABLE.fields]), path, batch_id)


def write_scored_table(scored: DataFrame, path: str, batch_id: int) -> str:
    """Scored rows in the columns and types of the scored table, one folder per batch."""
    return write_batch(scored.select(*[F.col(f.name).cast(f.dataType) for f in SCORED.fields]), path, batch_id)


def infer_json_schema(strings: DataFrame, column: str = "value") -> DataType:
    """Type of a column of JSON strings, merged over all of them in one distributed pass.

    Malformed strings and NULLs count for nothing; a field that is always null is a string.
    """
    found = strings.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column).cast("string")))).first()[0]
    return DataType.fromDDL(found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING"))


def write_history_csv(history: DataFrame, path: str) -> str:
    """History table as CSV with a header (``user,no_of_edits``)."""
    history.select("user", "no_of_edits").write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_history_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """History CSV with a header. The declared schema is the default (no inference pass);
    ``infer=True`` reproduces header + type inference and casts to the declared types."""
    reader = spark.read.option("header", "true")
    if infer:
        df = reader.option("inferSchema", "true").csv(path)
        return df.select(F.col("user").cast("string"), F.col("no_of_edits").cast("long"))
    return reader.schema(HISTORY).csv(path)


def read_envelopes(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON lines of raw envelopes (nested ``user`` struct), with the fixed schema."""
    from editflow.schemas import ENVELOPE

    reader = spark.readStream if stream else spark.read
    return reader.schema(ENVELOPE).json(path)


def _table_ddl(name: str, schema: StructType, location: str) -> str:
    """DDL of a batch-partitioned table; the columns are the sink's own schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    return (f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (batch_id) "
            f"LOCATION '{location}'")


def create_tables(spark: SparkSession, location: str, prefix: str = "") -> dict[str, str]:
    """Create the raw-edit and scored tables (parquet, partitioned by batch) in the catalog.

    No primary key on the raw table: it is an edit log, and a unique user key would reject
    every second edit of a user. ``append_if_absent`` is the operator for keyed appends.
    """
    names = {"raw": f"{prefix}wiki_edits_parsed", "scored": f"{prefix}scored_data"}
    spark.sql(_table_ddl(names["raw"], RAW_TABLE_WITH_BATCH, f"{location}/{names['raw']}"))
    spark.sql(_table_ddl(names["scored"], SCORED_WITH_BATCH, f"{location}/{names['scored']}"))
    return names


def user_counts_as_select(spark: SparkSession, raw_table: str, name: str, location: str) -> str:
    """``CREATE TABLE <name> AS SELECT user, count(user) AS no_of_edits ... GROUP BY user``."""
    spark.sql(
        f"""CREATE TABLE {name} USING parquet LOCATION '{location}' AS
            SELECT user, count(user) AS no_of_edits FROM {raw_table} GROUP BY user"""
    )
    return name


def bucket_history(history: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Store the history as a table bucketed and sorted by ``user`` and return it.

    A join on ``user`` against this table shuffles only the other side (into ``buckets``
    partitions); the history is read in place, bucket by bucket. For a stream that is the
    difference between moving the whole history every micro-batch and moving only the batch.
    """
    (
        history.repartition(buckets, "user")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "user")
        .sortBy("user")
        .saveAsTable(name)
    )
    return history.sparkSession.table(name)

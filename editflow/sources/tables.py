"""Readers for the parquet test tables and the adapter that turns events into edit notices.

The adapter is a pure projection of ``events`` (no shuffle), so every query built on it reads
the whole table and its work grows with it. ``event_type`` stands in for the chat channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions import reuse

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


# Declared schemas of the tables the queries read: the scan then needs no footer read for
# schema inference (one file here, thousands on a cluster).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; a plain parquet scan so filters and projections reach the reader."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def event_message(
    event_id: Column, user_id: Column, event_type: Column, props: Column
) -> Column:
    """Edit-notice line for one event.

    Every 11th event becomes a log line without a byte count (rejected by the parser);
    the others carry a title (Special:/Talk: prefixes by event type), a flag string cycling
    through M, !N, B and none, a diff URL, the user, a signed byte count and ``props`` as the
    summary.
    """
    title_prefix = (
        F.when(event_type == "error", F.lit("Special:"))
        .when(event_type == "signup", F.lit("Talk:"))
        .otherwise(F.lit(""))
    )
    m4 = event_id % 4
    flags = (
        F.when(m4 == 0, F.lit("M"))
        .when(m4 == 1, F.lit("!N"))
        .when(m4 == 2, F.lit("B"))
        .otherwise(F.lit(""))
    )
    bytes_raw = event_id * 37 % 2001
    sign = F.when(bytes_raw >= 1000, F.lit("+")).otherwise(F.lit(""))
    edit_line = F.concat(
        F.lit("[["), title_prefix, event_type, F.lit(" page "), _text(event_id % 97), F.lit("]] "),
        flags,
        F.lit(" https://example.org/w/index.php?diff="), _text(event_id),
        F.lit(" * user"), _text(user_id), F.lit(" * ("),
        sign, _text(bytes_raw - 1000), F.lit(") "), props,
    )
    log_line = F.concat(
        F.lit("[[Special:Log/"), event_type, F.lit("]] hit  * user"), _text(user_id),
        F.lit(" *  no byte count"),
    )
    return F.when(event_id % 11 == 0, log_line).otherwise(edit_line)


def edit_messages(events: DataFrame) -> DataFrame:
    """``events`` -> (event_id, ts, channel, message): the raw notice stream."""
    channel = reuse("event_channel", lambda: F.concat(F.lit("#"), F.col("event_type")).alias("channel"))
    message = reuse(
        "event_message",
        lambda: event_message(
            F.col("event_id"), F.col("user_id"), F.col("event_type"), F.col("props")
        ).alias("message"),
    )
    return events.select("event_id", "ts", channel, message)


def read_messages(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Raw notices from ``events``. ``partitions`` (or the session setting ``editflow.messages.partitions``,
    which the benchmark sets) spreads a table that has fewer splits than the cluster has cores; by
    default the scan's own splits stay as they are."""
    events = read_table(spark, sf_dir, "events")
    partitions = partitions or int(spark.conf.get("editflow.messages.partitions", "0"))
    return edit_messages(events.repartition(partitions, "event_id") if partitions else events)

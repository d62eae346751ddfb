"""Counts, changelogs and ratios over edits.

Every aggregate here is decomposable (count, max, max_by, count_if), so Spark runs a partial
aggregate in each map task before the shuffle: a user who owns a third of all rows still sends
only one row per map task across the network. The running count (the one non-decomposable
operator) range-partitions by user and time so no single task holds a whole user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editflow.functions.text import CHANGELOG_FORMAT
from editflow.operators.parse import only_edits
from editflow.session import checkpoint_root


def edits_by_user(edits: DataFrame, key: str = "user") -> DataFrame:
    """Current edit count per user over EDIT rows (the keyed table of the stream app)."""
    return only_edits(edits).groupBy(key).agg(F.count(F.lit(1)).alias("num_edits"))


def changelog_text(counts: DataFrame, key: str = "user", value: str = "num_edits") -> DataFrame:
    """One printable line per change, ``USER: <user> num.edits: <n>``."""
    return counts.select(
        F.format_string(CHANGELOG_FORMAT, F.col(key), F.col(value)).alias("line")
    )


def running_count(
    edits: DataFrame,
    key: str = "user",
    order: tuple[str, str] = ("ts", "event_id"),
    partitions: int | None = None,
) -> DataFrame:
    """Each edit with the count of its user's edits up to and including it (the changelog).

    Equal to ``count(*) OVER (PARTITION BY key ORDER BY ts, id ROWS UNBOUNDED PRECEDING)``,
    computed without putting one user's rows in one task:

    1. Range partition and sort by (key, ts, id): a hot user is split anywhere, between equal
       times too. Partition number and position are stamped and checkpointed, so both stay
       fixed whatever is recomputed later.
    2. Per (partition, user): the first position and the number of rows. A row's count inside
       its partition is its position less the first one.
    3. What the user had in earlier partitions: a running sum over the few partitions that
       the user spans, joined back on (partition, user); a partition's rows are the most that
       share such a key.

    The joins are null-safe: a row with a NULL key or time keeps its count.
    """
    checkpoint_root(edits.sparkSession)
    n = partitions or int(edits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stamped = (
        edits.repartitionByRange(n, key, *order).sortWithinPartitions(key, *order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33))
        .checkpoint(eager=True)
    )
    spans = stamped.groupBy("_pid", key).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        F.col("_pid").alias("_opid"), F.col(key).alias("_okey"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
    )
    same = (stamped["_pid"] == offsets["_opid"]) & stamped[key].eqNullSafe(offsets["_okey"])
    return (
        stamped.join(offsets, same, "inner")
        .withColumn("num_edits", F.col("_offset") + F.col("_pos"))
        .drop("_pid", "_pos", "_opid", "_okey", "_offset")
    )


def compact_changelog(
    changes: DataFrame, key: str = "user", value: str = "num_edits", seq: str = "seq"
) -> DataFrame:
    """Changelog -> current table: the value of the latest change per key."""
    return changes.groupBy(key).agg(F.max_by(value, seq).alias(value))


def error_rate(scored: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """One row: mismatches, rows, and their ratio (NULL for an empty input), in one pass."""
    return scored.agg(
        F.count_if(F.col(label) != F.col(prediction)).alias("errors"),
        F.count(F.lit(1)).alias("rows"),
        F.round(
            F.try_divide(F.count_if(F.col(label) != F.col(prediction)), F.count(F.lit(1))), 6
        ).alias("error_rate"),
    )


def confusion(scored: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """Counts per (actual, predicted) pair."""
    return scored.groupBy(
        F.col(label).alias("actual"), F.col(prediction).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def channel_progress(raw: DataFrame, channel: str = "channel", ts: str = "timestamp") -> DataFrame:
    """Latest source position (newest timestamp) and message count per channel."""
    return raw.groupBy(channel).agg(
        F.max(ts).alias("last_timestamp"), F.count(F.lit(1)).alias("messages")
    )


def append_if_absent(
    new_rows: DataFrame, table: DataFrame, key: str, order: str
) -> DataFrame:
    """Rows of ``new_rows`` to append under a unique key: first row per key, key not in table.

    ``min_by`` keeps the earliest row per key (partial aggregate, skew-safe); ``left_anti``
    removes keys the table already has.
    """
    value_cols = [c for c in new_rows.columns if c != key]
    first = new_rows.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in value_cols]), F.col(order)).alias("_row")
    )
    deduped = first.select(key, *[F.col(f"_row.{c}").alias(c) for c in value_cols])
    return deduped.join(table.select(key), key, "left_anti")

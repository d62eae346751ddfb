"""History enrichment, global row index and positional pairing.

Broadcasts happen only behind a size check: a side is broadcast when its bytes are known
to be under a bound (a config value, or a table whose size is fixed by construction, such as
one row per partition). Above the bound the join shuffles, and keys that hold a large share of
the rows are split out and joined against a broadcast of just their partner rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editflow.session import checkpoint_root

# A side of at most this many bytes may be broadcast. Override per call or with
# ``editflow.broadcast.maxBytes``.
BROADCAST_MAX_BYTES = 200 << 20
# A stream plans every micro-batch anew, so a broadcast static side is collected and sent
# again in every batch (every 2 seconds by default): its bound is ten times smaller.
# Override with ``editflow.stream.broadcast.maxBytes``.
STREAM_BROADCAST_MAX_BYTES = 20 << 20


def _broadcast_bound(df: DataFrame, default: int) -> int:
    conf = df.sparkSession.conf.get("editflow.broadcast.maxBytes", None)
    return int(conf) if conf else default


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the lengths of text and binary values, 8 for any other value and 8 a row."""
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    fixed = 8 * (len(df.columns) - len(wide) + 1)
    size = F.lit(fixed).cast("long")
    for c in wide:
        size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 8
    return size


def data_bytes(df: DataFrame) -> int:
    """Bytes of the rows, a distributed sum (partial sums per task, one number to the driver)."""
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def _bound(df: DataFrame, max_bytes: int | None) -> int:
    return max_bytes if max_bytes is not None else _broadcast_bound(df, BROADCAST_MAX_BYTES)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Size check before a broadcast: the bytes of ``df`` against the bound (0: never)."""
    bound = _bound(df, max_bytes)
    return bound > 0 and data_bytes(df) <= bound


def unique_bytes(df: DataFrame, key: str) -> int:
    """Bytes of the rows; raises if a key repeats, since a join would then multiply rows.

    Both come from one pass over ``df``, which matters where it is derived and not stored.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum(_row_bytes(df)).alias("_b"))
    most, which, size = per_key.agg(F.max("_n"), F.max_by(F.struct(key), "_n"), F.sum("_b")).first()
    if most and most > 1:
        raise ValueError(f"{key} is not unique: {which[0]!r} has {most} rows")
    return size or 0


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself; raises if a key repeats."""
    unique_bytes(df, key)
    return df


def _hot_share(df: DataFrame, hot_share: int | None) -> int:
    """A key is hot from one shuffle partition's mean on, so at most this many keys are."""
    return hot_share or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(left: DataFrame, key: str, hot_share: int | None = None) -> list:
    """Keys owning at least 1/hot_share of ``left``'s rows (at most ``hot_share`` of them;
    by default the number of shuffle partitions: a key that would fill one by itself).

    One exact aggregation over ``left`` (partial counts per task); the per-key counts are kept
    while the total and the hot keys are read from them, then released. Only the hot keys,
    a list bounded by ``hot_share``, reach the driver.
    """
    share = _hot_share(left, hot_share)
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = counts.agg(F.sum("_n")).first()[0] or 0
        threshold = max(1, -(-total // share))
        rows = counts.where(F.col(key).isNotNull() & (F.col("_n") >= threshold)).select(key).collect()
    finally:
        counts.unpersist()
    return [r[0] for r in rows]


def skew_split_left_join(
    left: DataFrame, right: DataFrame, key: str, hot_share: int | None = None
) -> DataFrame:
    """Left join on a unique-keyed ``right`` that stays balanced when some keys are hot.

    Rows of the hot keys (at most ``hot_share`` of them) take their partner from a broadcast
    of just those keys' ``right`` rows. Every row then goes through one sort-merge join; a hot
    row and a row without a key carry a join key spread by a hash of their own columns and an
    extra ``NOT spread`` condition, so they lie evenly and never match there. ``left`` is read
    twice in all (the hot-key count and the join) and no row is dropped or duplicated.
    """
    hot = hot_keys(left, key, hot_share)
    values = [c for c in right.columns if c != key]
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    hot_right = F.broadcast(
        right.where(is_hot).select(F.col(key), *[F.col(c).alias(f"_hot_{c}") for c in values])
    )
    spread = F.coalesce(F.col(key).isNull() | is_hot, F.lit(True))
    tagged = left.withColumn("_spread", spread).join(hot_right, key, "left")
    row = F.xxhash64(*[F.col(c) for c in left.columns]).cast("string")
    tagged = tagged.withColumn("_jk", F.when(F.col("_spread"), row).otherwise(F.col(key).cast("string")))
    cold_right = right.select(F.col(key).cast("string").alias("_rk"), *[F.col(c).alias(f"_cold_{c}") for c in values])
    # The side is past the broadcast bound: no size rule of Spark's may turn this into one.
    joined = tagged.join(cold_right.hint("merge"), (F.col("_jk") == F.col("_rk")) & ~F.col("_spread"), "left")
    return joined.select(  # the column order of ``left.join(right, key, "left")``
        F.col(key),
        *[F.col(c) for c in left.columns if c != key],
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(f"_cold_{c}")).alias(c) for c in values],
    )


def left_join_checked(
    left: DataFrame, right: DataFrame, key: str, max_bytes: int | None = None
) -> DataFrame:
    """``left LEFT JOIN right USING (key)``, ``right`` unique by key, with the broadcast decided
    by a size check."""
    size, bound = unique_bytes(right, key), _bound(right, max_bytes)
    if bound > 0 and size <= bound:
        return left.join(F.broadcast(right), key, "left")
    return skew_split_left_join(left, right, key)


def enrich_with_history(
    edits: DataFrame,
    history: DataFrame,
    key: str = "user",
    fill: int = 1,
    max_bytes: int | None = None,
) -> DataFrame:
    """Attach ``no_of_edits`` to each edit; users without history count as ``fill`` edits."""
    joined = left_join_checked(edits, history, key, max_bytes)
    return joined.fillna({"no_of_edits": fill})


def row_index(df: DataFrame, order: list[str], name: str = "index", partitions: int | None = None) -> DataFrame:
    """Global row number 0..n-1 in ``order`` (rows that tie on every order column get
    consecutive numbers in no particular order among themselves).

    1. ``repartitionByRange`` on the full order key plus a generated row id, and a sort inside
       each partition. A hot leading value is split by the later columns; a value repeated in
       every order column (rows that tie completely, which may stand in any order among
       themselves) is split by the row id, so no partition has to hold all of its rows.
    2. Partition id and position in partition are stamped, and the result is checkpointed
       to the shared checkpoint folder, so both stay fixed whatever is recomputed later.
    3. Rows per partition (one row per partition), their running sum, and a broadcast join
       of those offsets (size = partition count) give ``offset + position``.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = df.withColumn("_tie", F.monotonically_increasing_id())
    ordered = tagged.repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie")
    stamped = ordered.select(
        *df.columns,
        F.spark_partition_id().alias("_pid"),
        (
            F.monotonically_increasing_id()
            - F.shiftleft(F.spark_partition_id().cast("long"), 33)
        ).alias("_pos"),
    ).checkpoint(eager=True)
    sizes = stamped.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        stamped.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_pos"))
        .drop("_pid", "_pos", "_off")
    )


def positional_join(left: DataFrame, right: DataFrame, index: str = "index") -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` (both carry ``index``)."""
    return left.join(right, index, "inner")

"""Joins, counts and row index against brute-force equivalents, including a hot key."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from editflow.operators import aggregates as agg
from editflow.operators import joins


@pytest.fixture(scope="module")
def skewed_edits(spark):
    """3,000 edits where one user owns a third of the rows, spread over three days."""
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else f"u{i % 97}"
        rows.append((i, base + dt.timedelta(minutes=(i * 7) % 4320), user, "EDIT"))
    return spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP_NTZ, user STRING, type STRING")


def test_skew_split_equals_plain_join(spark, skewed_edits):
    history = spark.createDataFrame(
        [("hot", 10)] + [(f"u{i}", i) for i in range(0, 97, 2)], "user STRING, no_of_edits LONG"
    )
    plain = skewed_edits.join(history, "user", "left")
    split = joins.skew_split_left_join(skewed_edits, history, "user", hot_share=10)
    assert sorted(plain.collect()) == sorted(split.collect())
    assert split.count() == 3000


def test_enrich_fill_and_broadcast_check(spark, skewed_edits):
    history = spark.createDataFrame([("hot", 10)], "user STRING, no_of_edits LONG")
    small = joins.enrich_with_history(skewed_edits, history)
    forced = joins.enrich_with_history(skewed_edits, history, max_bytes=0)
    assert sorted(small.collect()) == sorted(forced.collect())
    assert small.where("no_of_edits = 1").count() == 2000


def test_running_count_matches_window(spark, skewed_edits):
    w = Window.partitionBy("user").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    brute = skewed_edits.select("event_id", F.count(F.lit(1)).over(w).alias("n"))
    ours = agg.running_count(skewed_edits).select("event_id", F.col("num_edits").alias("n"))
    assert sorted(brute.collect()) == sorted(ours.collect())


def test_running_count_hot_user_in_one_hour(spark):
    # A third of the rows belong to one user and fall inside one hour, many in the same
    # minute and some on the same timestamp (the event id breaks those ties).
    base = dt.datetime(2024, 3, 1, 10)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((i, base + dt.timedelta(seconds=(i * 13) % 3600 // 20 * 20), "hot"))
        else:
            rows.append((i, base + dt.timedelta(minutes=(i * 11) % 600), f"u{i % 41}"))
    df = spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP_NTZ, user STRING")
    w = Window.partitionBy("user").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    brute = df.select("event_id", F.count(F.lit(1)).over(w).alias("n"))
    ours = agg.running_count(df).select("event_id", F.col("num_edits").alias("n"))
    assert sorted(ours.collect()) == sorted(brute.collect())


def test_running_count_keeps_null_time_and_user(spark):
    rows = [(1, None, "a"), (2, dt.datetime(2024, 1, 1, 1), "a"), (3, dt.datetime(2024, 1, 1, 5), "a"),
            (4, dt.datetime(2024, 1, 1, 1), None), (5, None, None), (6, dt.datetime(2024, 1, 1, 1), "b")]
    df = spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP_NTZ, user STRING")
    w = Window.partitionBy("user").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    brute = df.select("event_id", F.count(F.lit(1)).over(w).alias("n"))
    ours = agg.running_count(df).select("event_id", F.col("num_edits").alias("n"))
    assert sorted(ours.collect()) == sorted(brute.collect())
    assert ours.count() == 6


def test_compact_changelog(spark):
    changes = spark.createDataFrame(
        [("a", 0, 1), ("a", 1, 3), ("b", 0, 2), ("a", 2, 4), ("b", 2, 5)], "user STRING, seq LONG, num_edits LONG"
    )
    got = {r.user: r.num_edits for r in agg.compact_changelog(changes).collect()}
    assert got == {"a": 4, "b": 5}


def test_row_index_splits_a_repeated_key(spark):
    # A third of the rows share one order value: they must not all land in one partition.
    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    idx = joins.row_index(df, ["k"], partitions=6)
    per_part = [r[0] for r in idx.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(per_part) < 2000
    rows = sorted((r["index"], r["k"]) for r in idx.collect())
    assert [i for i, _ in rows] == list(range(6000))
    assert [k for _, k in rows] == sorted(k for _, k in rows)


def test_row_index_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 3).alias("v"))
    idx = joins.row_index(df, ["k", "v"], partitions=7)
    rows = sorted(idx.collect(), key=lambda r: r["index"])
    assert [r["index"] for r in rows] == list(range(5000))
    assert [(r.k, r.v) for r in rows] == sorted((r.k, r.v) for r in df.collect())


def test_row_index_hot_leading_value(spark):
    # A third of the rows share the leading key; the range split uses the second column.
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id"))
    idx = joins.row_index(df, ["k", "id"], partitions=6)
    got = [r.id for r in idx.orderBy("index").collect()]
    assert got == [r.id for r in df.orderBy("k", "id").collect()]


def test_append_if_absent(spark):
    new = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("c", 5, "w")], "user STRING, event_id LONG, t STRING")
    table = spark.createDataFrame([("c",)], "user STRING")
    got = sorted(tuple(r) for r in agg.append_if_absent(new, table, "user", "event_id").collect())
    assert got == [("a", 1, "y"), ("b", 2, "z")]


def test_error_rate_empty_batch_is_null(spark):
    empty = spark.createDataFrame([], "actual INT, predicted INT")
    r = agg.error_rate(empty).collect()[0]
    assert (r.errors, r.rows, r.error_rate) == (0, 0, None)


def test_reused_column_serves_several_frames(spark):
    from editflow.functions import reuse

    doubled = reuse(("test", "doubled"), lambda: (F.col("x") * 2).alias("y"))
    assert reuse(("test", "doubled"), lambda: F.lit(None)) is doubled  # built once
    a = spark.range(3).withColumnRenamed("id", "x").select(doubled)
    b = spark.createDataFrame([(10,)], "x INT").select(doubled)
    assert [r.y for r in a.collect()] == [0, 2, 4] and [r.y for r in b.collect()] == [20]

"""Physical-plan properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from editflow.operators import joins
from editflow.plans.catalog import features, history, parsed
from editflow.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_reads_only_needed_columns(spark):
    plan = _plan(parsed(spark, SF).select("user"))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,props:string>" in plan or (
        "value:double" not in plan and "ts:timestamp_ntz" not in plan
    )


def test_counts_aggregate_before_the_shuffle(spark):
    from editflow.operators.aggregates import edits_by_user

    plan = _plan(edits_by_user(parsed(spark, SF)))
    assert "partial_count" in plan
    # One shuffle on the key (the other exchange, on event_id, spreads the one-file input).
    assert plan.count("Exchange hashpartitioning(user") == 1


def test_history_broadcast_only_under_bound(spark):
    small = joins.left_join_checked(features(spark, SF), history(spark, SF), "user")
    assert "BroadcastHashJoin" in _plan(small)
    # Above the bound only the hot keys' history rows are broadcast; the rest is a sort-merge
    # join, whatever Spark's own size rule says.
    forced = joins.skew_split_left_join(features(spark, SF), history(spark, SF), "user", hot_share=100)
    assert "BroadcastHashJoin" in _plan(forced)  # hot keys' history rows
    forced.collect()
    assert "SortMergeJoin" in _plan(forced)  # everything else, after adaptive planning too
    plain = joins.left_join_checked(features(spark, SF), history(spark, SF), "user", max_bytes=0)
    assert "SortMergeJoin" in _plan(plain)


def test_null_and_hot_keys_lie_evenly(spark):
    n, parts = 15_000, 8
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(
            F.concat(F.lit("u"), F.col("id").cast("string"))).alias("user"), "id")
    counts = spark.createDataFrame([("hot", 5), ("u2", 7)], "user string, no_of_edits long")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = joins.skew_split_left_join(rows, counts, "user")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        got = {r["no_of_edits"]: r["count"] for r in out.groupBy("no_of_edits").count().collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == {5: n // 3, 7: 1, None: n - n // 3 - 1}
    assert max(sizes) < 1.5 * n / parts


def test_repeated_history_key_is_refused(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "user string, no_of_edits long")
    with pytest.raises(ValueError, match="not unique"):
        joins.enrich_with_history(twice.select("user"), twice)


def test_declared_schema_scan(spark):
    df = read_table(spark, SF, "events")
    assert df.schema.simpleString().startswith("struct<event_id:bigint,ts:timestamp_ntz")


def test_bucketed_history_is_not_shuffled(spark, scratch):
    from editflow.sources.files import bucket_history

    name = "hist_bucketed_test"
    table = bucket_history(history(spark, SF), name, scratch(name), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(features(spark, SF).join(table, "user", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # Exactly one shuffle on user: the features side; the bucketed table is read in place.
    assert plan.count("Exchange hashpartitioning(user") == 1


def test_running_count_parses_once(spark):
    from editflow.operators.aggregates import running_count

    edits = parsed(spark, SF).select("event_id", "ts", "user")
    df = running_count(edits)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    # The numbered rows are a checkpoint: neither the scan nor the range partitioning runs again.
    assert "FileScan parquet" not in final and "rangepartitioning" not in final


def test_show_rows_is_a_top_k(spark):
    from editflow.operators.display import first_rows

    df = first_rows(parsed(spark, SF), ["event_id"])
    assert "TakeOrderedAndProject(limit=20" in _plan(df)
    ids = [r.event_id for r in df.collect()]
    assert ids == sorted(r.event_id for r in parsed(spark, SF).select("event_id").collect())[:20]

"""Unique-key appends, range differences and paced streams."""

from pyspark.sql import functions as F

from editflow.operators.aggregates import append_if_absent
from editflow.operators.topics import topic_diff, topic_diff_ranges
from editflow.plans.catalog import history, parsed
from editflow.plans.streams import raw_topic_records
from editflow.sources import store
from editflow.sources.topics import read_stored_topic, read_topic, store_topic, write_topic
from editflow.streaming import keyed
from editflow.streaming import pipeline as P
from editflow.streaming.pacing import PaceLog, read_pace, run_paced

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_append_survives_restart_and_replay(spark, scratch):
    records, topic, out, checkpoint = raw_topic_records(spark, SF), scratch("topic"), scratch("table"), scratch("ckpt")
    past = history(spark, SF).limit(20)
    past = spark.createDataFrame(past.collect(), past.schema)

    def run():
        rows = P.raw_to_edits(read_topic(spark, topic, stream=True)).select(
            "user", (F.col("offset") * 4 + F.col("partition")).alias("event_id"), "title", "byteDiff")
        P.run_to_end(keyed.start_append_if_absent(rows, past, out, checkpoint, order=("event_id",),
                                                  trigger=P.AVAILABLE_NOW, buckets=3, fold_every=2))

    for k in range(4):
        write_topic(records.where(F.floor(F.col("offset") / 70) == k), topic)
        run()
    want = _rows(append_if_absent(parsed(spark, SF).select("user", "event_id", "title", "byteDiff"), past, "user", "event_id"))
    assert _rows(keyed.read_appended(spark, out).select("user", "event_id", "title", "byteDiff")) == want
    store.remove(spark, f"{checkpoint}/commits/3")
    run()
    assert _rows(keyed.read_appended(spark, out).select("user", "event_id", "title", "byteDiff")) == want


def test_ranges_equal_the_whole_comparison(spark, scratch):
    records = raw_topic_records(spark, SF)
    cols = ["partition", "offset", "key", "value"]
    at = F.col("offset") * 4 + F.col("partition")
    replicas = [
        records,
        records.where(~at.isin(5, 6, 777)).withColumn("value", F.when(at == 400, "x").otherwise(F.col("value"))),
        records.unionByName(records.where(at == 9)),  # one record twice
        records.withColumn("key", F.when(at == 11, F.lit(None)).otherwise(F.col("key"))),
        records.limit(0),
        records.withColumn("offset", F.when(at == 3, F.lit(None)).otherwise(F.col("offset"))),
        records.withColumn("partition", F.when(at == 3, 99).otherwise(F.col("partition"))),
    ]
    for replica in replicas:
        for fan, leaf in ((4, 8), (1024, 1024)):
            got = _rows(topic_diff_ranges(records, replica, fan, leaf))
            assert got == _rows(topic_diff(records, replica, cols).select(*cols, "side"))
    assert topic_diff_ranges(records.limit(0), records.limit(0)).isEmpty()


def test_second_pass_reads_only_differing_ranges(spark, scratch, capsys):
    records = raw_topic_records(spark, SF)
    left, right = (read_stored_topic(spark, store_topic(r, scratch("stored"))) for r in (records, records.where("partition <> 2 or offset <> 100")))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        diff = topic_diff_ranges(left, right, fan=4, leaf=8)
        assert [tuple(r)[:2] for r in diff.collect()] == [(2, 100)]
        diff.explain()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(offset,96)" in plan and "LessThan(offset,104)" in plan


def test_paced_batches_are_logged(spark, scratch):
    records, topic, out = raw_topic_records(spark, SF), scratch("topic"), scratch("out")
    for k in range(6):
        write_topic(records.where(F.floor(F.col("offset") / 45) == k).coalesce(1), topic)
    log = PaceLog(spark, scratch("pace"))
    spark.streams.addListener(log)
    try:
        stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
        query = P.copy_topic(stream, out, scratch("ckpt"), "copy")  # the default two-second trigger
        run_paced(query, log)
    finally:
        spark.streams.removeListener(log)
    rows = read_pace(spark, log.path).orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == list(range(6)) and sum(r.input_rows for r in rows) == records.count()
    slots = [int(r.started.timestamp() * 1000) // 2000 for r in rows]
    assert all(b > a for a, b in zip(slots, slots[1:]))
    assert all(r.duration_ms > 0 and r.delay_ms == max(0, r.duration_ms - 2000) for r in rows)
    assert len(store.names(spark, log.path)) == 1

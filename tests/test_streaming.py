"""Streaming: stream = batch, restart from checkpoint, quarantine, idempotent batch sinks."""

import json
import os

from pyspark.sql import functions as F

from editflow.operators import aggregates as agg
from editflow.plans.catalog import parsed
from editflow.plans.streams import raw_topic_records
from editflow.sources.files import write_batch
from editflow.sources.topics import read_topic, write_topic
from editflow.streaming import pipeline as P

SF = "/root/testdata/sf0.001"


def _counts(df):
    return {r.user: r.num_edits for r in df.collect()}


def test_stream_counts_equal_batch_and_survive_restart(spark, scratch):
    """Two runs on one checkpoint: the second sees only new files, totals stay exact."""
    records = raw_topic_records(spark, SF)
    topic, sink, ckpt = scratch("topic"), scratch("counts"), scratch("ckpt")
    first = records.where(F.col("offset") < 100)
    second = records.where(F.col("offset") >= 100)
    write_topic(first, topic, files=2)
    stream = lambda: P.raw_to_edits(read_topic(spark, topic, stream=True, max_files_per_trigger=1))
    P.run_to_end(P.start_counts(stream(), sink, ckpt, P.AVAILABLE_NOW))
    mid = _counts(P.read_counts(spark, sink))
    assert mid == _counts(agg.edits_by_user(P.raw_to_edits(first)))
    write_topic(second, topic, files=2)
    P.run_to_end(P.start_counts(stream(), sink, ckpt, P.AVAILABLE_NOW))
    assert _counts(P.read_counts(spark, sink)) == _counts(agg.edits_by_user(parsed(spark, SF)))
    # Running the finished query again on the same checkpoint adds nothing.
    batches = spark.read.parquet(sink).select("batch_id").distinct().count()
    P.run_to_end(P.start_counts(stream(), sink, ckpt, P.AVAILABLE_NOW))
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == batches


def test_corrupt_json_goes_to_quarantine(spark, scratch):
    topic = scratch("topic")
    os.makedirs(topic)
    good = {"timestamp": 1, "channel": "#c", "message": "[[T]]  https://x * u * (+5) s",
            "user": {"nick": "n", "username": "~n", "host": "h"}}
    lines = [
        {"key": "1", "value": json.dumps(good), "topic": "t", "partition": 0, "offset": 0},
        {"key": "2", "value": "{not json", "topic": "t", "partition": 0, "offset": 1},
        {"key": "3", "value": json.dumps({"timestamp": 3, "channel": "#c"}), "topic": "t", "partition": 0, "offset": 2},
    ]
    with open(os.path.join(topic, "part-0.json"), "w") as fh:
        fh.write("\n".join(json.dumps(x) for x in lines) + "\n")
    records = read_topic(spark, topic)
    assert [r.offset for r in P.raw_to_edits(records).collect()] == [0]
    rejects = {r.offset: r[P.fjson.CORRUPT] for r in P.raw_rejects(records).collect()}
    assert set(rejects) == {1, 2}
    assert rejects[1] == "{not json" and rejects[2] is None


def test_batch_sink_is_idempotent(spark, scratch):
    path = scratch("sink")
    df = spark.range(5)
    write_batch(df, path, 3)
    write_batch(df, path, 3)
    write_batch(df, path, 4)
    assert spark.read.parquet(path).count() == 10


def test_scoring_stream_writes_all_sinks(spark, scratch):
    from editflow.plans.catalog import history, rule_prediction

    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=3)
    base = scratch("score")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects")}
    stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
    P.run_to_end(P.start_scoring(stream, history(spark, SF), rule_prediction, paths, scratch("ckpt"), P.AVAILABLE_NOW))
    n_parsed = parsed(spark, SF).count()
    assert spark.read.parquet(paths["raw"]).count() == n_parsed
    assert spark.read.parquet(paths["scored"]).count() == n_parsed
    assert spark.read.parquet(paths["rejects"]).count() == 1000 - n_parsed
    metrics = spark.read.parquet(paths["metrics"])
    assert metrics.agg(F.sum("rows")).collect()[0][0] == n_parsed
    files = [f for f in os.listdir(topic) if f.endswith(".json")]
    assert metrics.count() == len(files)  # one micro-batch per topic file


def test_changelog_lines_stream(spark, scratch):
    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=2)
    out = scratch("lines")
    stream = P.raw_to_edits(read_topic(spark, topic, stream=True, max_files_per_trigger=1))
    P.run_to_end(P.start_changelog_lines(stream, out, scratch("ckpt"), P.AVAILABLE_NOW))
    lines = spark.read.text(out)
    final = agg.changelog_text(agg.edits_by_user(parsed(spark, SF)))
    # Every final line appears among the emitted changes (the last update of each user).
    assert final.join(lines.withColumnRenamed("value", "line"), "line", "left_anti").count() == 0
    assert lines.count() >= final.count()


def test_history_csv_inferred_equals_declared(spark, scratch):
    from editflow.plans.catalog import history
    from editflow.sources.files import read_history_csv, write_history_csv

    path = write_history_csv(history(spark, SF), scratch("csv"))
    declared = read_history_csv(spark, path)
    inferred = read_history_csv(spark, path, infer=True)
    assert declared.schema == inferred.schema
    assert sorted(declared.collect()) == sorted(inferred.collect())


def test_stream_vote_equals_batch_vote(spark, scratch):
    from editflow.operators import model as M
    from editflow.plans.catalog import enriched, history

    rows = enriched(spark, SF)
    model = M.fit(rows, num_trees=5, seed=3)
    path = M.save(model, scratch("model"))
    voter = M.voter(model, M.leaf_classes(spark, path, model))
    batch = voter(rows).select("event_id", "predicted")

    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=2)
    base = scratch("score")
    paths = {"raw": f"{base}/raw", "scored": f"{base}/scored"}
    stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
    P.run_to_end(P.start_scoring(stream, history(spark, SF), voter, paths, scratch("ckpt"), P.AVAILABLE_NOW))
    streamed = spark.read.parquet(paths["scored"]).select(
        (F.col("offset") * 4 + F.col("partition")).alias("event_id"), "predicted"
    )
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_declared_scoring_equals_per_batch_scoring(spark, scratch):
    """Under the broadcast bound the scoring plan is declared once on the stream; above it
    each batch builds the skew-split join. Both write the same raw, reject and scored rows."""
    from editflow.plans.catalog import history, rule_prediction

    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=2)
    out = {}
    for bound in (None, "0"):
        if bound is not None:
            spark.conf.set("editflow.broadcast.maxBytes", bound)
        try:
            base = scratch("score")
            paths = {k: f"{base}/{k}" for k in ("raw", "scored", "rejects")}
            stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
            query = P.start_scoring(stream, history(spark, SF), rule_prediction, paths, scratch("ckpt"), P.AVAILABLE_NOW)
            P.run_to_end(query)
        finally:
            spark.conf.unset("editflow.broadcast.maxBytes")
        out[bound] = {k: sorted(map(tuple, spark.read.parquet(p).collect())) for k, p in paths.items()}
    assert out[None]["raw"] and out[None]["scored"] and out[None]["rejects"]
    assert out[None] == out["0"]


def test_history_reloaded_every_n_batches(spark, scratch):
    from editflow.plans.catalog import history

    loads = []

    def load():
        loads.append(len(loads) + 1)
        return history(spark, SF).withColumn("no_of_edits", F.lit(1000 * loads[-1] + 7).cast("long"))

    assert not callable(history(spark, SF))  # a DataFrame is not taken for a loader
    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=4)
    out = scratch("enriched")
    edits = P.raw_to_edits(read_topic(spark, topic, stream=True, max_files_per_trigger=1))
    P.run_to_end(P.start_enrich(edits, load, out, scratch("ckpt"), P.AVAILABLE_NOW, reload_every=2))
    seen = {
        (r.batch_id, r.no_of_edits)
        for r in spark.read.parquet(out).where("no_of_edits <> 1").select("batch_id", "no_of_edits").distinct().collect()
    }
    assert loads == [1, 2]
    assert seen == {(0, 1007), (1, 1007), (2, 2007), (3, 2007)}


def test_batches_with_nothing_to_score(spark, scratch):
    """Quirks Q2/Q3: a batch in which no row parses writes empty tables with their fixed
    columns and a NULL error rate, and every row goes to the quarantine; nothing fails."""
    from editflow.plans.catalog import history, rule_prediction
    from editflow.schemas import RAW_TABLE

    records = raw_topic_records(spark, SF).withColumn("value", F.lit("{not json"))
    topic = write_topic(records, scratch("topic"), files=2)
    base = scratch("score")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects")}
    stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
    P.run_to_end(P.start_scoring(stream, history(spark, SF), rule_prediction, paths, scratch("ckpt"), P.AVAILABLE_NOW))
    raw, scored = spark.read.parquet(paths["raw"]), spark.read.parquet(paths["scored"])
    assert raw.count() == 0 and scored.count() == 0
    assert [f.name for f in RAW_TABLE.fields] == [c for c in raw.columns if c != "batch_id"]
    assert {"user", "predicted", "no_of_edits"} <= set(scored.columns)
    assert spark.read.parquet(paths["rejects"]).where("_corrupt_record IS NOT NULL").count() == 1000
    metrics = spark.read.parquet(paths["metrics"]).collect()
    assert len(metrics) == 2 and all(m.rows == 0 and m.error_rate is None for m in metrics)


def test_stream_broadcast_bound_precedence(spark):
    from editflow.operators.joins import STREAM_BROADCAST_MAX_BYTES

    df = spark.range(1)
    assert P._stream_bound(df, None) == STREAM_BROADCAST_MAX_BYTES  # below the batch bound
    assert P._stream_bound(df, 5) == 5
    try:
        spark.conf.set("editflow.broadcast.maxBytes", "7")
        assert P._stream_bound(df, None) == 7
        spark.conf.set("editflow.stream.broadcast.maxBytes", "9")
        assert P._stream_bound(df, None) == 9
    finally:
        spark.conf.unset("editflow.broadcast.maxBytes")
        spark.conf.unset("editflow.stream.broadcast.maxBytes")


def test_scoring_stream_restart_scores_each_row_once(spark, scratch):
    """Two runs on one checkpoint, then a third with nothing new: every parsed row is in the
    raw and scored tables exactly once, keyed by (partition, offset)."""
    from editflow.plans.catalog import history, rule_prediction

    records = raw_topic_records(spark, SF)
    topic, base, ckpt = scratch("topic"), scratch("score"), scratch("ckpt")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored")}
    stream = lambda: read_topic(spark, topic, stream=True, max_files_per_trigger=1)
    run = lambda: P.run_to_end(
        P.start_scoring(stream(), history(spark, SF), rule_prediction, paths, ckpt, P.AVAILABLE_NOW)
    )
    write_topic(records.where(F.col("offset") < 100), topic, files=2)
    run()
    write_topic(records.where(F.col("offset") >= 100), topic, files=2)
    run()
    run()
    n_parsed = parsed(spark, SF).count()
    scored = spark.read.parquet(paths["scored"])
    assert spark.read.parquet(paths["raw"]).count() == n_parsed
    assert scored.count() == n_parsed
    assert scored.select("partition", "offset").distinct().count() == n_parsed


def test_declared_scoring_plan_broadcasts_the_snapshot(spark, scratch):
    import contextlib
    import io

    from editflow.plans.catalog import history, rule_prediction

    topic = write_topic(raw_topic_records(spark, SF), scratch("topic"), files=1)
    base = scratch("score")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored")}
    stream = read_topic(spark, topic, stream=True, max_files_per_trigger=1)
    query = P.start_scoring(stream, history(spark, SF), rule_prediction, paths, scratch("ckpt"), P.AVAILABLE_NOW)
    try:
        query.awaitTermination(300)
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            query.explain()
        plan = text.getvalue()
    finally:
        P.run_to_end(query)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    # The stream's rows are not shuffled, and the history is read from the query's own snapshot.
    assert "Exchange hashpartitioning" not in plan and "lineitem" not in plan


def test_spread_fills_every_task_from_a_file_of_the_topic(spark, scratch):
    """One file of a topic cut by (partition, offset) is dealt over all tasks, not to those of its remainder."""
    from editflow.schemas import TOPIC_RECORD

    records = spark.range(4000).selectExpr(
        "cast(null as string) as key", "cast(id as string) as value", "'t' as topic", "cast(id % 4 as int) as partition",
        "id div 4 as offset", "timestamp_seconds(id) as timestamp")
    path = write_topic(records, scratch("cut"), files=8)
    one = spark.read.schema(TOPIC_RECORD).json(sorted(
        r[0] for r in spark.read.text(path).select("_metadata.file_path").distinct().collect())[0])
    sizes = [r["count"] for r in P._dealt(one, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == one.count() > 300 and len(sizes) == 16 and max(sizes) < 4 * one.count() / 16

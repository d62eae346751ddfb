"""The envelope reader, parser and scorer on a sample of thirty lines written for these tests."""

import os

import pytest
from pyspark.sql import functions as F

from editflow.operators import features as feat
from editflow.operators import joins
from editflow.operators import model as M
from editflow.operators.parse import only_edits, parse_edits, parse_rejects
from editflow.schemas import SCORED_WITH_BATCH
from editflow.sources.files import create_tables, infer_json_schema, read_envelopes, write_scored_table
from editflow.streaming import pipeline as P
from editflow.sources.topics import read_topic

SAMPLE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data", "envelopes.jsonl")


@pytest.fixture(scope="module")
def raw(spark):
    return read_envelopes(spark, SAMPLE)


def test_counts(raw):
    edits = parse_edits(raw)
    assert raw.count() == 30
    assert edits.count() == 20
    assert parse_rejects(raw).count() == 10
    assert {r["type"]: r["count"] for r in edits.groupBy("type").count().collect()} == {"EDIT": 10, "TALK": 5, "SPECIAL": 5}
    assert only_edits(edits).count() == 10


def test_fields(raw):
    edits = parse_edits(raw)
    got = edits.agg(*[F.sum(F.col(c).cast("int")).alias(c) for c in ("isMinor", "isNew", "isUnpatrolled", "isBotEdit")]).first()
    assert got.asDict() == {"isMinor": 5, "isNew": 6, "isUnpatrolled": 6, "isBotEdit": 5}
    assert {r["user"] for r in edits.collect()} == {"Ann", "Bo", "Cara Lind", "Dé", "E_7"}


def test_smallest_byte_count_has_a_size(raw):
    sizes = {r[0] for r in feat.feature_rows(parse_edits(raw)).select("total_byte_change").collect()}
    assert sizes == {12, 5, 0, 340, 2**31, 2**31 - 1, 7}


def test_inferred_schema(spark):
    rows = spark.createDataFrame([('{"a": 1, "b": {"c": [true]}}',), ('{"a": 2.5}',), ("{broken",), (None,)], "value string")
    kind = infer_json_schema(rows)
    got = rows.select(F.from_json("value", kind).alias("v")).select("v.a", "v.b.c").collect()
    assert [float(r["a"]) if r["a"] is not None else None for r in got] == [1.0, 2.5, None, None]
    assert got[0]["c"] == [True]


def test_scored_table_is_readable(spark, scratch, raw):
    history = spark.createDataFrame([("Ann", 2**40)], "user string, no_of_edits long")
    rows = feat.fill_missing_history(joins.enrich_with_history(feat.feature_rows(parse_edits(raw)), history))
    rows = rows.withColumns({"partition": F.lit(0), "offset": F.lit(None).cast("long"), "predicted": F.lit(1)})
    base = scratch("tables")
    names = create_tables(spark, base, prefix="own_sample_")
    write_scored_table(rows, f"{base}/{names['scored']}", batch_id=3)
    spark.sql(f"MSCK REPAIR TABLE {names['scored']}")
    stored = spark.table(names["scored"])
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in SCORED_WITH_BATCH]
    assert stored.agg(F.max("no_of_edits"), F.count("*")).first() == (2**40, 20)
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_saved_model_scores_alike(spark, scratch, raw):
    rows = feat.feature_rows(parse_edits(raw)).withColumn("no_of_edits", F.length("user").cast("long"))
    rows = rows.withColumn("total_byte_change", F.col("total_byte_change") % 1000)
    model = M.fit(rows, num_trees=5)
    path = M.save(model, scratch("model"))
    assert M.score(M.load(path), rows).collect() == M.score(model, rows).collect()


def test_text_records_have_places_and_are_scored(spark, scratch):
    """Notices from text files: every record has its own partition and offset, none is lost."""
    lines, topic = scratch("lines"), scratch("topic")
    envelopes = read_envelopes(spark, SAMPLE).where("message is not null")
    envelopes.select(F.to_json(F.struct("timestamp", "channel", "message")).alias("value")).repartition(3).write.text(lines)
    P.run_to_end(P.text_to_topic(spark.readStream.text(lines), topic, scratch("ckpt"), "text", P.AVAILABLE_NOW))
    records = read_topic(spark, topic)
    assert records.count() == envelopes.count()
    assert records.select("partition", "offset").where("offset is not null").distinct().count() == envelopes.count()
    # the same records without a place are scored all the same
    bare = scratch("bare")
    records.withColumns({"partition": F.lit(None).cast("int"), "offset": F.lit(None).cast("long")}).write.json(bare)
    history = spark.createDataFrame([("Ann", 3)], "user string, no_of_edits long")
    paths = {k: scratch(k) for k in ("raw", "scored")}
    query = P.start_scoring(read_topic(spark, bare, stream=True), history, lambda df: df.withColumn("predicted", F.lit(0)),
                            paths, scratch("ckpt"), P.AVAILABLE_NOW)
    P.run_to_end(query)
    assert P.source_lag(query)[0]["input_rows"] is not None
    assert spark.read.parquet(paths["scored"]).count() == 20


def test_running_count_of_one_user_at_one_time(spark):
    from editflow.operators.aggregates import running_count

    rows = spark.range(5000).select(F.lit("u").alias("user"), F.lit(7).alias("ts"), F.col("id").alias("event_id"))
    out = running_count(rows.unionByName(spark.createDataFrame([(None, 7, 9000)], "user string, ts int, event_id long")), partitions=6)
    got = {r["event_id"]: r["num_edits"] for r in out.collect()}
    assert got == {**{k: k + 1 for k in range(5000)}, 9000: 1}


def test_topic_diff_counts_copies(spark):
    from editflow.operators.topics import topic_diff

    left = spark.createDataFrame([("a", "1")] * 3 + [("b", None)], "key string, value string")
    right = spark.createDataFrame([("a", "1"), ("c", "2"), ("c", "2")], "key string, value string")
    got = sorted((r["key"], r["side"]) for r in topic_diff(left, right).collect())
    assert got == [("a", "left_only")] * 2 + [("b", "left_only")] + [("c", "right_only")] * 2

"""Golden numbers on the source system's own 36-line sample of raw envelopes.

The sample is read in place from the path in ``EDITFLOW_SAMPLE_JSON``; the test is skipped
when the variable is unset or the file is absent. Its rows are not copied into this repository.
"""

import os

import pytest
from pyspark.sql import functions as F

from editflow.operators import features as feat
from editflow.operators.parse import only_edits, parse_edits, parse_rejects
from editflow.schemas import ENVELOPE

SAMPLE = os.environ.get("EDITFLOW_SAMPLE_JSON", "")

pytestmark = pytest.mark.skipif(not (SAMPLE and os.path.exists(SAMPLE)), reason="EDITFLOW_SAMPLE_JSON not set")


@pytest.fixture(scope="module")
def raw(spark):
    return spark.read.schema(ENVELOPE).json(SAMPLE).withColumn("line", F.monotonically_increasing_id() + 1)


def test_counts(raw):
    edits = parse_edits(raw)
    assert raw.count() == 36
    assert edits.count() == 31
    assert sorted(r.line for r in parse_rejects(raw).collect()) == [2, 3, 18, 31, 32]
    types = {r["type"]: r["count"] for r in edits.groupBy("type").count().collect()}
    assert types == {"EDIT": 28, "TALK": 3}


def test_flags_and_sums(raw):
    e = parse_edits(raw)
    row = e.agg(
        F.sum(F.col("isNew").cast("int")).alias("new"),
        F.sum(F.col("isMinor").cast("int")).alias("minor"),
        F.sum(F.col("isUnpatrolled").cast("int")).alias("unp"),
        F.sum(F.col("isBotEdit").cast("int")).alias("bot"),
        F.count_if(F.col("byteDiff") > 0).alias("pos"),
        F.sum("byteDiff").alias("sum"),
        F.sum(F.abs("byteDiff")).alias("abs"),
        F.sum(F.length("summary")).alias("chars"),
        F.sum(F.octet_length("summary")).alias("bytes"),
    ).collect()[0]
    assert (row.new, row.minor, row.unp, row.bot) == (1, 1, 1, 3)
    assert (row.pos, row.sum, row.abs, row.chars, row.bytes) == (21, 10425, 12325, 1408, 1410)


def test_users(raw):
    counts = {r.user: r.c for r in only_edits(parse_edits(raw)).groupBy("user").agg(F.count("*").alias("c")).collect()}
    assert len(counts) == 25
    assert sorted(c for c in counts.values() if c > 1) == [2, 3]


def test_features_use_characters(raw):
    f = feat.feature_rows(parse_edits(raw))
    assert f.agg(F.sum("summary_bytes")).collect()[0][0] == 1408

"""Registered streaming queries.

Each stages the raw topic from ``events`` (a batch write of the whole table into a file topic
under the shared checkpoint folder), runs the streaming job with ``availableNow`` and a
quarter of the files per micro-batch (so state and changelogs span several batches), and returns a
batch DataFrame of what the sinks wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions import json as fjson
from editflow.operators import topics as ops_topics
from editflow.plans import sql as S
from editflow.plans.catalog import (
    ORACLE,
    _EDIT_Q,
    _EPOCH_MS,
    _Q,
    envelopes,
    history,
    register,
    rule_prediction,
)
from editflow.schemas import EDIT_FIELDS, ENVELOPE, FEATURES
from editflow.session import scratch_path
from editflow.sources.topics import read_topic, to_records, write_topic
from editflow.streaming import pipeline as P

RAW_TOPIC = "edits-raw"
TOPIC_PARTITIONS = 4
# The staged topic is read in about this many micro-batches, whatever its size.
STAGE_BATCHES = 4


def raw_topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw topic records for every event: key = ingest ms, value = envelope JSON,
    partition = event_id mod 4, offset = dense position inside the partition."""
    encoded = ops_topics.encode_raw(envelopes(spark, sf_dir))
    return to_records(
        encoded,
        key=F.col("key"),
        value=F.col("value"),
        topic=RAW_TOPIC,
        offset=F.floor(F.col("event_id") / TOPIC_PARTITIONS),
        timestamp=F.timestamp_millis(F.col("key").cast("long")),
        partition=F.col("event_id") % TOPIC_PARTITIONS,
    )


def stage_files(records: DataFrame) -> int:
    """As many files as the scan has splits, and as the cluster runs tasks at once at least."""
    return max(records.rdd.getNumPartitions(), records.sparkSession.sparkContext.defaultParallelism)


def stage_raw_topic(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    records = raw_topic_records(spark, sf_dir)
    return write_topic(records, scratch_path(spark, "topic-raw"), files=files or stage_files(records))


def _event_id() -> F.Column:
    return (F.col("offset") * TOPIC_PARTITIONS + F.col("partition")).alias("event_id")


def _raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = raw_topic_records(spark, sf_dir)
    files = stage_files(records)
    topic = write_topic(records, scratch_path(spark, "topic-raw"), files=files)
    return read_topic(spark, topic, stream=True, max_files_per_trigger=-(-files // STAGE_BATCHES))


_PARSED_SQL = S.parsed_query(f"SELECT event_id, channel, {_EDIT_Q} FROM parsed")


@register("stream_file_source", _PARSED_SQL)
def q_stream_file_source(spark, sf_dir):
    """File topic read as a stream, parsed, appended to a parquet sink."""
    edits = P.raw_to_edits(_raw_stream(spark, sf_dir))
    out = scratch_path(spark, "stream-parsed")
    writer = (
        edits.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "ckpt"))
        .trigger(availableNow=True)
    )
    P.run_to_end(writer.start())
    return spark.read.parquet(out).select(_event_id(), "channel", *EDIT_FIELDS)


_COUNTS_SQL = S.parsed_query("""SELECT "user", count(*) AS num_edits FROM parsed WHERE "type" = 'EDIT' GROUP BY "user\"""")


@register("stream_edits_by_user", _COUNTS_SQL)
def q_stream_edits_by_user(spark, sf_dir):
    """Running count per user (update mode, RocksDB state), changelog compacted at the end."""
    sink = scratch_path(spark, "stream-counts")
    edits = P.raw_to_edits(_raw_stream(spark, sf_dir))
    P.run_to_end(P.start_counts(edits, sink, scratch_path(spark, "ckpt"), P.AVAILABLE_NOW))
    return P.read_counts(spark, sink)


@register(
    "stream_enrich",
    S.parsed_query(f"SELECT event_id, {_Q}, no_of_edits FROM enr", S.FEATURES, S.HISTORY, S.ENRICHED),
)
def q_stream_enrich(spark, sf_dir):
    """Stream-static left join with history, fill and drop, appended to parquet."""
    sink = scratch_path(spark, "stream-enriched")
    edits = P.raw_to_edits(_raw_stream(spark, sf_dir))
    P.run_to_end(P.start_enrich(edits, history(spark, sf_dir), sink, scratch_path(spark, "ckpt"), P.AVAILABLE_NOW))
    cols = ["user", "type_bool", "summary_bytes", "total_byte_change", "addition_or_deletion",
            "isBotEdit", "isMinor", "isUnpatrolled", "isNew", "no_of_edits"]
    return spark.read.parquet(sink).select(_event_id(), *cols)


@register(
    "stream_enrich_skew_split",
    S.parsed_query(f"SELECT event_id, {_Q}, no_of_edits FROM enr", S.FEATURES, S.HISTORY, S.ENRICHED),
)
def q_stream_enrich_skew_split(spark, sf_dir):
    """Stream-static enrichment through the path for a history above the broadcast bound."""
    sink = scratch_path(spark, "stream-enriched")
    edits = P.raw_to_edits(_raw_stream(spark, sf_dir))
    query = P.start_enrich(
        edits, history(spark, sf_dir), sink, scratch_path(spark, "ckpt"), P.AVAILABLE_NOW, max_history_bytes=0
    )
    P.run_to_end(query)
    cols = ["user", "type_bool", "summary_bytes", "total_byte_change", "addition_or_deletion",
            "isBotEdit", "isMinor", "isUnpatrolled", "isNew", "no_of_edits"]
    return spark.read.parquet(sink).select(_event_id(), *cols)


@register("topic_roundtrip_parsed", S.parsed_query(f'SELECT event_id, "user" AS "key", {_EDIT_Q} FROM parsed'))
def q_topic_roundtrip_parsed(spark, sf_dir):
    """Write parsed edits to a parsed topic, and continue from that topic in a second query."""
    parsed_topic = scratch_path(spark, "topic-parsed")
    P.run_to_end(P.start_parse_to_topic(_raw_stream(spark, sf_dir), parsed_topic, scratch_path(spark, "ckpt"), P.AVAILABLE_NOW))
    edits = P.decode_parsed(read_topic(spark, parsed_topic, stream=True))
    out = scratch_path(spark, "stream-from-parsed")
    writer = (
        edits.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True)
    )
    P.run_to_end(writer.start())
    return spark.read.parquet(out).select(_event_id(), "key", *EDIT_FIELDS)


@register("topic_copy", S.with_ctes(S.RAW, body=f'SELECT event_id, CAST({_EPOCH_MS} AS VARCHAR) AS "key", message FROM raw'))
def q_topic_copy(spark, sf_dir):
    """Replay the raw topic into a second topic (key, partition, offset kept), read the copy."""
    copy_path = scratch_path(spark, "topic-copy")
    P.run_to_end(P.copy_topic(_raw_stream(spark, sf_dir), copy_path, scratch_path(spark, "ckpt"), "edits-raw-copy", P.AVAILABLE_NOW))
    return P.decode_raw(read_topic(spark, copy_path)).select(_event_id(), "key", "message")


@register(
    "topic_diff",
    S.with_ctes(
        S.RAW, S.GROUPS,
        body=f"""SELECT CAST({_EPOCH_MS} AS VARCHAR) AS "key", message, 'left_only' AS side
                 FROM grp2 WHERE NOT (m AND bd IS NOT NULL)""",
    ),
)
def q_topic_diff(spark, sf_dir):
    """Compare the raw topic with a replica that lost the unparsable records."""
    records = raw_topic_records(spark, sf_dir)
    kept = P.raw_to_edits(records).select("partition", "offset")
    replica = records.join(kept, ["partition", "offset"], "left_semi")
    diff = ops_topics.topic_diff(records, replica)
    message = fjson.decode(F.col("value"), ENVELOPE).getField("message")
    return diff.select("key", message.alias("message"), "side")


@register(
    "topic_fingerprint",
    S.with_ctes(
        S.RAW,
        body=f"""SELECT '{RAW_TOPIC}' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", count(*) AS records,
          CAST(sum(('0x' || substr(md5(concat_ws('|', CAST({_EPOCH_MS} AS VARCHAR),
            to_json({{'timestamp': {_EPOCH_MS}, 'channel': channel, 'message': message,
                     'user': {{'nick': 'relay-bot', 'username': '~relay-bot', 'host': 'relay.example'}}}}),
            CAST(event_id // 4 AS VARCHAR))), 1, 15))::BIGINT) AS VARCHAR) AS checksum
          FROM raw GROUP BY 2""",
    ),
)
def q_topic_fingerprint(spark, sf_dir):
    """Record count and checksum per partition of the raw topic."""
    return ops_topics.topic_fingerprint(raw_topic_records(spark, sf_dir))


_LAG_CUTOFF = "2024-01-15 00:00:00"


@register(
    "topic_lag",
    f"""WITH rec AS (SELECT event_id % 4 AS "partition", event_id // 4 AS "offset", ts FROM events),
        ends AS (SELECT "partition", max("offset") + 1 AS end_offset FROM rec GROUP BY 1),
        com AS (SELECT "partition", max("offset") + 1 AS committed_offset FROM rec
                WHERE ts < TIMESTAMP '{_LAG_CUTOFF}' GROUP BY 1)
     SELECT '{RAW_TOPIC}' AS topic, CAST(e."partition" AS INTEGER) AS "partition", CAST(end_offset AS BIGINT) AS end_offset,
            CAST(coalesce(committed_offset, 0) AS BIGINT) AS committed_offset,
            CAST(end_offset - coalesce(committed_offset, 0) AS BIGINT) AS lag
     FROM ends e LEFT JOIN com c ON e."partition" = c."partition\"""",
)
def q_topic_lag(spark, sf_dir):
    """Reader lag per partition against the position committed at the cutoff time."""
    records = raw_topic_records(spark, sf_dir)
    committed = (
        records.where(F.col("timestamp") < F.to_timestamp(F.lit(_LAG_CUTOFF)))
        .groupBy("topic", "partition")
        .agg((F.max("offset") + 1).alias("committed_offset"))
    )
    return ops_topics.topic_lag(records, committed)


@register("file_to_topic", S.with_ctes(S.RAW, body="SELECT message AS line FROM raw"))
def q_file_to_topic(spark, sf_dir):
    """Text files -> topic (file source connector) -> text files (file sink connector)."""
    text_in = scratch_path(spark, "text-in")
    envelopes(spark, sf_dir).select(F.col("envelope.message").alias("value")).write.text(text_in)
    topic = scratch_path(spark, "topic-text")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(text_in)
    P.run_to_end(P.text_to_topic(lines, topic, scratch_path(spark, "ckpt"), "edits-text", P.AVAILABLE_NOW))
    text_out = scratch_path(spark, "text-out")
    P.run_to_end(P.topic_to_text(read_topic(spark, topic, stream=True), text_out, scratch_path(spark, "ckpt"), P.AVAILABLE_NOW))
    return spark.read.text(text_out).select(F.col("value").alias("line"))


_STREAM_SCORED_SQL = S.parsed_query(
    f"""SELECT event_id, "user", {", ".join(f'"{c}"' for c in FEATURES)}, "isBotEdit",
          CAST(total_byte_change > 500 AS INTEGER) AS predicted FROM enr""",
    S.FEATURES, S.HISTORY, S.ENRICHED,
)


def _run_scoring(spark, sf_dir, scorer):
    base = scratch_path(spark, "stream-score")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects")}
    query = P.start_scoring(
        _raw_stream(spark, sf_dir), history(spark, sf_dir), scorer, paths,
        scratch_path(spark, "ckpt"), P.AVAILABLE_NOW,
    )
    P.run_to_end(query)
    return paths


@register("stream_two_sinks", _STREAM_SCORED_SQL)
def q_stream_two_sinks(spark, sf_dir):
    """Raw table + scored table (rule-based scorer) + metrics from one micro-batch pass."""
    paths = _run_scoring(spark, sf_dir, rule_prediction)
    return spark.read.parquet(paths["scored"]).select(_event_id(), "user", *FEATURES, "isBotEdit", "predicted")


@register("stream_batch_totals", ORACLE["error_rate"])
def q_stream_batch_totals(spark, sf_dir):
    """The per-batch log summed over all micro-batches: rows, errors and their ratio equal the
    batch error rate of the whole input (the per-batch values depend on how it was cut)."""
    paths = _run_scoring(spark, sf_dir, rule_prediction)
    return spark.read.parquet(paths["metrics"]).agg(
        F.sum("errors").alias("errors"),
        F.sum("rows").alias("rows"),
        F.round(F.try_divide(F.sum("errors"), F.sum("rows")), 6).alias("error_rate"),
    )


_LOG_BATCHES = 4


@register(
    "stream_batch_log",
    S.parsed_query(
        f"""SELECT event_id % {_LOG_BATCHES} AS batch_id, count(*) AS "rows",
              count_if("isBotEdit" <> CAST(total_byte_change > 500 AS INTEGER)) AS errors,
              round(count_if("isBotEdit" <> CAST(total_byte_change > 500 AS INTEGER)) / count(*), 6) AS error_rate,
              true AS in_order
            FROM enr GROUP BY 1""",
        S.FEATURES, S.HISTORY, S.ENRICHED,
    ),
)
def q_stream_batch_log(spark, sf_dir):
    """Per-batch log: number, rows, errors and error rate of each micro-batch, and whether its time
    is not before the batch before. The batches are cut by topic partition: one run of the
    query on the same checkpoint for each, after its records have come in."""
    from pyspark.sql import Window

    records = raw_topic_records(spark, sf_dir)
    base, topic, checkpoint = scratch_path(spark, "stream-log"), scratch_path(spark, "topic-raw"), scratch_path(spark, "ckpt")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects")}
    past = history(spark, sf_dir)
    for k in range(_LOG_BATCHES):
        write_topic(records.where(F.col("partition") == k), topic)
        stream = read_topic(spark, topic, stream=True)
        P.run_to_end(P.start_scoring(stream, past, rule_prediction, paths, checkpoint, P.AVAILABLE_NOW))
    log = spark.read.parquet(paths["metrics"])
    before = F.lag("batch_time").over(Window.orderBy("batch_id"))  # one row per batch
    return log.select("batch_id", "rows", "errors", "error_rate",
                      F.coalesce(F.col("batch_time") >= before, F.lit(True)).alias("in_order"))

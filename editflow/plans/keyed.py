"""Registered queries of keyed topics, per-record changes, complete batches, state and positions.

Each cuts the raw topic into four micro-batches that the SQL can name (a source partition or a quarter
of the time span each) by running the same job on one checkpoint after every part has come in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions import murmur
from editflow.plans import sql as S
from editflow.plans.catalog import ORACLE, history, register, rule_prediction
from editflow.plans.streams import RAW_TOPIC, TOPIC_PARTITIONS, _COUNTS_SQL, _event_id, raw_topic_records
from editflow.session import scratch_path
from editflow.sources.topics import read_topic, write_topic
from editflow.streaming import commits, keyed, positions
from editflow.streaming import pipeline as P

BATCHES = 4


def by_source(records: DataFrame) -> F.Column:
    """Batch of a record: its source partition."""
    return F.col("partition") % BATCHES


def by_time(records: DataFrame) -> F.Column:
    """Batch of a record: its quarter of the time span."""
    micros = F.unix_micros("timestamp")
    low, high = records.agg(F.min(micros), F.max(micros)).first()
    return F.floor((micros - F.lit(low)) * BATCHES / F.lit(high - low + 1))


def staged_runs(spark, sf_dir: str, cut: Callable, run: Callable, batches=range(BATCHES), topic: str | None = None) -> str:
    """Append each part to a topic and run the job to its end; returns the topic."""
    records = raw_topic_records(spark, sf_dir)
    topic, part = topic or scratch_path(spark, "topic-raw"), cut(records)
    for k in batches:
        write_topic(records.where(part == k), topic)
        run(read_topic(spark, topic, stream=True))
    return topic


# ------------------------------------------------------------------------------ keyed topic


def _times_sql(x: str) -> str:
    return f"(({x}) * {murmur.MULTIPLIER} & {murmur.MASK})"


def _word_sql(hx: str, n: int) -> str:
    return "('0x' || " + " || ".join(f"{hx}[{2 * k + 1}:{2 * k + 2}]" for k in reversed(range(n))) + ")::BIGINT"


_MURMUR_SQL = f"""hashed0 AS (
  SELECT *, hex("user") AS hx, strlen("user") AS size, list_reduce(
    list_transform(list_transform(regexp_extract_all(hex("user"), '.{{8}}'), lambda w: {_times_sql(_word_sql("w", 4))}),
                   lambda k: {_times_sql("xor(k, k >> 24)")}),
    lambda h, k: xor({_times_sql("h")}, k), xor({murmur.SEED}::BIGINT, strlen("user"))) AS h0
  FROM parsed),
hashed1 AS (
  SELECT *, CASE size % 4 {" ".join(
      f"WHEN {n} THEN {_times_sql('xor(h0, ' + _word_sql('hx[size // 4 * 8 + 1:]', n) + ')')}" for n in (1, 2, 3))}
    ELSE h0 END AS h1 FROM hashed0),
hashed2 AS (SELECT *, {_times_sql("xor(h1, h1 >> 13)")} AS h2 FROM hashed1),
dealt AS (SELECT *, CAST((xor(h2, h2 >> 15) & 2147483647) % {TOPIC_PARTITIONS} AS INTEGER) AS "to" FROM hashed2)"""


@register(
    "topic_keyed_parsed",
    S.parsed_query(
        f"""SELECT "user" AS "key", "diffUrl", "to" AS "partition",
              row_number() OVER (PARTITION BY "to" ORDER BY event_id % {TOPIC_PARTITIONS}, event_id) - 1 AS "offset"
            FROM dealt""",
        _MURMUR_SQL,
    ),
)
def q_topic_keyed_parsed(spark, sf_dir):
    """Parsed topic dealt by the user's hash, offsets without a gap over four micro-batches."""
    topic, checkpoint = scratch_path(spark, "topic-keyed"), scratch_path(spark, "ckpt")
    staged_runs(spark, sf_dir, by_source, lambda raw: P.run_to_end(
        keyed.start_keyed_topic(raw, topic, checkpoint, TOPIC_PARTITIONS, trigger=P.AVAILABLE_NOW)))
    return P.decode_parsed(read_topic(spark, topic)).select("key", "diffUrl", "partition", "offset")


# ------------------------------------------------------------------------------ changes and table


@register("stream_changelog_running", ORACLE["changelog_running"])
def q_stream_changelog_running(spark, sf_dir):
    """One change for each record of the stream: its user's count after it, over four batches in time order."""
    out, checkpoint = scratch_path(spark, "changelog"), scratch_path(spark, "ckpt")
    staged_runs(spark, sf_dir, by_time, lambda raw: P.run_to_end(keyed.start_running_changelog(
        P.raw_to_edits(raw), out, checkpoint, order=("record_ts", "offset", "partition"), trigger=P.AVAILABLE_NOW)))
    return keyed.read_changes(spark, out).select(_event_id(), "user", "num_edits")


def _counted(spark, sf_dir, fold_every: int = 1) -> tuple[str, str]:
    sink, checkpoint = scratch_path(spark, "stream-counts"), scratch_path(spark, "ckpt")
    staged_runs(spark, sf_dir, by_source, lambda raw: P.run_to_end(
        P.start_counts(P.raw_to_edits(raw), sink, checkpoint, P.AVAILABLE_NOW, fold_every=fold_every)))
    return sink, checkpoint


@register("counts_snapshot", _COUNTS_SQL)
def q_counts_snapshot(spark, sf_dir):
    """The running counts from the snapshot and the last batch's changes alone."""
    return P.read_counts(spark, _counted(spark, sf_dir)[0])


@register("state_table", _COUNTS_SQL)
def q_state_table(spark, sf_dir):
    """The running counts read from the query's state in its checkpoint."""
    return positions.state_table(spark, _counted(spark, sf_dir)[1]).select("user", F.col("count").alias("num_edits"))


@register(
    "state_changes",
    S.parsed_query(
        f"""SELECT DISTINCT event_id % {BATCHES} AS batch_id, "user",
              count(*) OVER (PARTITION BY "user" ORDER BY event_id % {BATCHES}) AS num_edits
            FROM parsed WHERE "type" = 'EDIT'"""
    ),
)
def q_state_changes(spark, sf_dir):
    """The change feed of that state: each user's count after every batch that changed it."""
    feed = positions.state_changes(spark, _counted(spark, sf_dir)[1])
    return feed.where("change_type = 'update'").select("batch_id", "user", F.col("count").alias("num_edits"))


# ------------------------------------------------------------------------------ complete batches


class Interrupted(RuntimeError):
    """Raised between two sinks to stand for a lost driver."""


@register(
    "stream_crash_replay",
    S.parsed_query(
        f"""SELECT * FROM (VALUES ('raw'), ('scored'), ('metrics'), ('rejects')) AS s(sink), LATERAL (
              SELECT CASE WHEN sink = 'rejects' THEN (SELECT count(*) FROM raw) - count(*) ELSE count(*) END AS "rows",
                CASE WHEN sink = 'rejects' THEN (SELECT count(*) FROM raw WHERE event_id % {BATCHES} < 2) - count_if(event_id % {BATCHES} < 2)
                     ELSE count_if(event_id % {BATCHES} < 2) END AS rows_between
              FROM parsed)"""
    ),
)
def q_stream_crash_replay(spark, sf_dir):
    """A failure between two sinks of the third batch: what a reader of complete batches sees before the
    restart (two batches, in every sink) and after it (each record once)."""
    base, checkpoint = scratch_path(spark, "stream-crash"), scratch_path(spark, "ckpt")
    paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects", "commits")}
    past = history(spark, sf_dir)

    def start(raw, after_sink=None):
        return P.start_scoring(raw, past, rule_prediction, paths, checkpoint, P.AVAILABLE_NOW, after_sink=after_sink)

    def seen(name: str) -> DataFrame:
        rows = commits.read_committed(spark, paths[name], paths["commits"])
        count = F.sum("rows") if name == "metrics" else F.count(F.lit(1))
        return rows.agg(F.lit(name).alias("sink"), count.cast("long").alias("rows"))

    def all_seen() -> DataFrame:
        return seen("raw").unionByName(seen("scored")).unionByName(seen("metrics")).unionByName(seen("rejects"))

    def fail(name: str, batch_id: int) -> None:
        if name == "raw":
            raise Interrupted(f"after {name} of batch {batch_id}")

    topic = staged_runs(spark, sf_dir, by_source, lambda raw: P.run_to_end(start(raw)), range(2))

    def crash(raw):
        try:
            P.run_to_end(start(raw, fail))
        except Exception as e:  # the query reports the failure of its batch
            if "after raw of batch 2" not in str(e):
                raise

    staged_runs(spark, sf_dir, by_source, crash, [2], topic)
    between = spark.createDataFrame(all_seen().collect(), "sink string, rows long")  # four rows, as they are now
    P.run_to_end(start(read_topic(spark, topic, stream=True)))
    staged_runs(spark, sf_dir, by_source, lambda raw: P.run_to_end(start(raw)), [3], topic)
    return all_seen().join(between.withColumnRenamed("rows", "rows_between"), "sink")


# ------------------------------------------------------------------------------ positions

_LAG_RUNS = 2


@register(
    "topic_lag_committed",
    f"""SELECT '{RAW_TOPIC}' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", CAST(max(event_id // 4) + 1 AS BIGINT) AS end_offset,
          CASE WHEN event_id % 4 < {_LAG_RUNS} THEN CAST(max(event_id // 4) + 1 AS BIGINT) ELSE 0 END AS committed_offset,
          CASE WHEN event_id % 4 < {_LAG_RUNS} THEN 0 ELSE CAST(max(event_id // 4) + 1 AS BIGINT) END AS lag
        FROM events GROUP BY event_id % 4""",
)
def q_topic_lag_committed(spark, sf_dir):
    """Lag against the positions in the query's own logs: two batches are committed, the third was planned
    and failed, the fourth's records came later."""
    from editflow.operators.topics import topic_lag
    from editflow.sources.files import write_batch

    out, checkpoint = scratch_path(spark, "lag-out"), scratch_path(spark, "ckpt")

    def run(raw):
        def sink(batch, batch_id):
            if batch_id >= _LAG_RUNS:
                raise Interrupted("this batch stays open")
            write_batch(batch, out, batch_id)

        query = raw.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            P.run_to_end(query)
        except Exception as e:
            if "this batch stays open" not in str(e):
                raise

    topic = staged_runs(spark, sf_dir, by_source, run, range(_LAG_RUNS + 1))
    records = raw_topic_records(spark, sf_dir)
    write_topic(records.where(by_source(records) == BATCHES - 1), topic)
    now = read_topic(spark, topic)
    return topic_lag(now, positions.file_positions(now, checkpoint))


# ------------------------------------------------------------------------------ unique keys


@register("stream_append_if_absent", ORACLE["append_if_absent"])
def q_stream_append_if_absent(spark, sf_dir):
    """Append edits to a table keyed by user, which starts from the history's users, over four batches."""
    out, checkpoint = scratch_path(spark, "keyed-table"), scratch_path(spark, "ckpt")
    past = history(spark, sf_dir)

    def run(raw):
        rows = P.raw_to_edits(raw).select("user", _event_id(), "title", "byteDiff")
        P.run_to_end(keyed.start_append_if_absent(
            rows, past, out, checkpoint, order=("event_id",), trigger=P.AVAILABLE_NOW, fold_every=2))

    staged_runs(spark, sf_dir, by_time, run)
    return keyed.read_appended(spark, out)


# ------------------------------------------------------------------------------ differing ranges

_LOST = ("2024-01-10 00:00:00", "2024-01-10 06:00:00")
_CHANGED = ("2024-01-20 00:00:00", "2024-01-20 03:00:00")


@register(
    "topic_diff_ranges",
    f"""WITH rec AS (SELECT CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset", epoch_us(ts) // 1000 AS ms FROM events),
        marked AS (SELECT *, ms >= epoch_us(TIMESTAMP '{_LOST[0]}') // 1000 AND ms < epoch_us(TIMESTAMP '{_LOST[1]}') // 1000 AS lost,
          ms >= epoch_us(TIMESTAMP '{_CHANGED[0]}') // 1000 AND ms < epoch_us(TIMESTAMP '{_CHANGED[1]}') // 1000 AS changed FROM rec)
     SELECT "partition", "offset", 'left_only' AS side FROM marked WHERE lost OR changed
     UNION ALL SELECT "partition", "offset", 'right_only' FROM marked WHERE changed""",
)
def q_topic_diff_ranges(spark, sf_dir):
    """Locate the differences of a replica that lost one span of time and has other values in a second."""
    from editflow.operators.topics import topic_diff_ranges
    from editflow.sources.topics import read_stored_topic, store_topic

    records = raw_topic_records(spark, sf_dir)
    between = lambda span: (F.col("timestamp") >= F.lit(span[0]).cast("timestamp")) & (F.col("timestamp") < F.lit(span[1]).cast("timestamp"))
    changed = F.when(between(_CHANGED), F.upper("value")).otherwise(F.col("value"))
    replica = records.where(~between(_LOST)).withColumn("value", changed)
    copies = [read_stored_topic(spark, store_topic(r, scratch_path(spark, "topic-stored"))) for r in (records, replica)]
    return topic_diff_ranges(*copies, fan=16, leaf=64).select("partition", "offset", "side")


# ------------------------------------------------------------------------------ pace


@register(
    "stream_paced_log",
    f"""SELECT event_id % {BATCHES} AS batch_id, count(*) AS input_rows, true AS on_time FROM events GROUP BY 1""",
)
def q_stream_paced_log(spark, sf_dir):
    """The log of a stream under the two-second trigger: rows of each batch, and whether it started in a later
    interval than the batch before (triggers fall on multiples of the interval)."""
    from pyspark.sql import Window

    from editflow.sources.files import write_batch
    from editflow.streaming.pacing import PaceLog, read_pace, run_paced

    records, topic, out = raw_topic_records(spark, sf_dir), scratch_path(spark, "topic-raw"), scratch_path(spark, "paced")
    for k in range(BATCHES):  # one file for each batch, in order
        write_topic(records.where(by_source(records) == k).coalesce(1), topic)
    log = PaceLog(spark, scratch_path(spark, "pace"))
    spark.streams.addListener(log)
    try:
        stream = P.raw_to_edits(read_topic(spark, topic, stream=True, max_files_per_trigger=1))
        writer = stream.writeStream.foreachBatch(lambda batch, n: write_batch(batch, out, n)).option(
            "checkpointLocation", scratch_path(spark, "ckpt"))
        run_paced(P._trigger(writer, None).start(), log)
    finally:
        spark.streams.removeListener(log)
    pace = read_pace(spark, log.path)
    before = F.lag("started").over(Window.partitionBy("run").orderBy("batch_id"))  # one row a batch
    slot = lambda t: F.floor(F.unix_millis(t) / F.col("interval_ms"))
    return pace.select("batch_id", "input_rows", F.coalesce(slot("started") > slot(before), F.lit(True)).alias("on_time"))


# ------------------------------------------------------------------------------ files of envelopes


@register("envelope_lines", "SELECT ".join(ORACLE["envelope_build"].rsplit("SELECT event_id, ", 1)))
def q_envelope_lines(spark, sf_dir):
    """Envelopes written as JSON lines and read back with the fixed schema."""
    from editflow.plans.catalog import envelopes
    from editflow.sources.files import read_envelopes

    path = scratch_path(spark, "envelopes")
    envelopes(spark, sf_dir).select("envelope.*").write.json(path)
    read = read_envelopes(spark, path)
    return read.select("timestamp", "channel", "message", "user.nick", "user.username", "user.host")

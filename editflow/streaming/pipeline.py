"""Streaming jobs: raw topic -> parsed topic, running per-user counts, enrichment, scoring.

Each builder returns a started ``StreamingQuery``. All transformations are the same
``DataFrame -> DataFrame`` functions the batch queries use. Delivery is exactly-once at the
sink: every query has a checkpoint, and every ``foreachBatch`` sink writes its output into a
folder named after the batch id with overwrite, so a batch replayed after a failure replaces
its own output.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editflow.functions import json as fjson
from editflow.operators import aggregates as agg
from editflow.operators import features as feat
from editflow.operators import joins
from editflow.operators.parse import edits_from_tagged, parse_edits, parse_rejects, rejects_from_tagged, tag_edits
from editflow.operators.topics import encode_parsed
from editflow.schemas import ENVELOPE, EDIT, EDIT_FIELDS
from editflow.session import ROCKSDB_PROVIDER, scratch_path
from editflow.sources.files import write_batch, write_raw_table, write_scored_table
from editflow.streaming import commits
from editflow.streaming.tables import SnapshotTable

DEFAULT_TRIGGER = {"processingTime": "2 seconds"}
LOG = logging.getLogger("editflow.streaming")


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or DEFAULT_TRIGGER))


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed state in RocksDB (off-heap, spills to local disk, changelog checkpoints)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def decode_raw(records: DataFrame) -> DataFrame:
    """Topic records -> (key, partition, offset, record timestamp, envelope fields, corrupt text)."""
    env = fjson.decode(F.col("value"), ENVELOPE).alias("env")
    return records.select("key", "partition", "offset", F.col("timestamp").alias("record_ts"), env).select(
        "key",
        "partition",
        "offset",
        "record_ts",
        F.col("env.timestamp").alias("timestamp"),
        F.col("env.channel").alias("channel"),
        F.col("env.message").alias("message"),
        F.col(f"env.{fjson.CORRUPT}").alias(fjson.CORRUPT),
    )


def raw_to_edits(records: DataFrame) -> DataFrame:
    """Raw topic -> parsed edits (malformed JSON and unparsable messages drop out here and
    come back through ``raw_rejects``)."""
    return parse_edits(decode_raw(records).drop(fjson.CORRUPT))


def raw_rejects(records: DataFrame) -> DataFrame:
    """Quarantine rows: malformed JSON, missing message, or a message that does not parse."""
    return parse_rejects(decode_raw(records))


def decode_parsed(records: DataFrame) -> DataFrame:
    """Parsed topic -> edit rows (key, partition, offset and the ten fields)."""
    value = fjson.decode(F.col("value"), EDIT).alias("v")
    return records.select("key", "partition", "offset", value).select(
        "key", "partition", "offset", *[F.col(f"v.{f}").alias(f) for f in EDIT_FIELDS]
    )


# ------------------------------------------------------------------------ query builders


def start_parse_to_topic(
    records: DataFrame, topic_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Raw topic -> parsed topic (key = editor, value = edit JSON), file sink."""
    edits = raw_to_edits(records).drop("key")
    out = encode_parsed(edits).select(
        "key",
        "value",
        F.lit("edits-parsed").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        "offset",
        "record_ts",
    ).withColumnRenamed("record_ts", "timestamp")
    writer = out.writeStream.format("json").option("path", topic_path).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def start_counts(
    edits: DataFrame, sink_path: str, checkpoint: str, trigger: dict | None = None, fold_every: int = 8, buckets: int = 32
) -> StreamingQuery:
    """Running edit count per user, emitted in update mode (one row per changed user per
    batch), each batch written to ``sink_path/batch_id=<n>`` and, every ``fold_every`` batches,
    folded into a snapshot (``SnapshotTable``) so that readers don't scan old changes.

    The state holds one row per user ever seen and is never dropped (the counts are
    unbounded by definition), so it lives in RocksDB.
    """
    use_rocksdb_state(edits.sparkSession)
    counts = agg.edits_by_user(edits)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, sink_path, buckets=buckets, fold_every=fold_every)
        table.write(batch, batch_id)
        table.commit(batch_id)

    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start()


def read_counts(spark: SparkSession, sink_path: str) -> DataFrame:
    """Current table: the snapshot and the complete batches after it, the latest count per user.

    A changelog written without a snapshot or markers is compacted as a whole.
    """
    table = SnapshotTable(spark, sink_path).read()
    return table if table is not None else agg.compact_changelog(spark.read.parquet(sink_path), seq="batch_id")


def _stream_bound(history: DataFrame, max_bytes: int | None) -> int:
    """The broadcast bound of a stream: an explicit ``max_bytes``, else
    ``editflow.stream.broadcast.maxBytes``, else ``editflow.broadcast.maxBytes``, else the
    stream default (tighter than the batch one: every micro-batch broadcasts the side again)."""
    if max_bytes is not None:
        return max_bytes
    conf = history.sparkSession.conf
    for key in ("editflow.stream.broadcast.maxBytes", "editflow.broadcast.maxBytes"):
        value = conf.get(key, None)
        if value:
            return int(value)
    return joins.STREAM_BROADCAST_MAX_BYTES


def _snapshot(history: DataFrame) -> DataFrame:
    """The history as it is now, written once to the shared folder. Every batch joins this copy,
    whatever its size, so what a batch sees never depends on how large the history is."""
    spark = history.sparkSession
    path = scratch_path(spark, "history")
    history.write.parquet(path)
    return joins.require_unique(spark.read.schema(history.schema).parquet(path), "user")


def _history_join(history: DataFrame, max_bytes: int | None):
    """(join, whether it is one plain per-row join): size picks the join, never the rows."""
    if joins.fits_broadcast(history, _stream_bound(history, max_bytes)):
        return (lambda left: left.join(F.broadcast(history), "user", "left")), True
    return (lambda left: joins.skew_split_left_join(left, history, "user")), False


def _history_joiner(
    history: DataFrame | Callable[[], DataFrame],
    max_bytes: int | None = None,
    reload_every: int = 0,
):
    """Per-batch left join with a snapshot of the history, taken once per query (as the source
    pipeline reads it once).

    Under the stream's broadcast bound every batch broadcasts the snapshot; above it each batch
    runs the hot-key split join against it, because adaptive skew handling does not apply
    inside streaming plans. With ``reload_every`` > 0 and a loader function the history is
    read again every that many batches (see ``ReloadingHistory``).
    """
    if reload_every > 0 and callable(history):
        return ReloadingHistory(history, reload_every, max_bytes)
    chosen, static = _history_join(_snapshot(history() if callable(history) else history), max_bytes)
    join = lambda left: chosen(left)
    join.static, join.prepare = static, lambda batch_id: None
    return join


class ReloadingHistory:
    """The history join of a long-running stream, with the history read again every
    ``every`` micro-batches, so that new counts reach the scores.

    The source pipeline reads its history once, so a stream that runs for weeks joins
    ever older counts. Here ``load()`` is called when a batch starts a new period of ``every``
    batch ids (and on the first batch after a restart, which reads the history as it is
    then), a new snapshot is taken and the size check is made again. The join is built per
    batch.
    """

    static = False

    def __init__(self, load: Callable[[], DataFrame], every: int, max_bytes: int | None = None):
        self.load, self.every, self.max_bytes = load, every, max_bytes
        self.period, self._join = None, None

    def prepare(self, batch_id: int) -> None:
        period = int(batch_id) // self.every
        if period != self.period:
            self._join, _ = _history_join(_snapshot(self.load()), self.max_bytes)
            self.period = period

    def __call__(self, left: DataFrame) -> DataFrame:
        return self._join(left)


def start_enrich(
    edits: DataFrame,
    history: DataFrame | Callable[[], DataFrame],
    sink_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_history_bytes: int | None = None,
    reload_every: int = 0,
) -> StreamingQuery:
    """Stream-static left join with the history table, then fill and drop; each batch is
    written to ``sink_path/batch_id=<n>`` (replay-safe). ``history`` may be a loader function;
    with ``reload_every`` > 0 it is called again every that many batches."""
    join = _history_joiner(history, max_history_bytes, reload_every)
    features = feat.feature_rows(edits, keep=["partition", "offset"])
    enrich = lambda df: feat.drop_incomplete(feat.fill_missing_history(join(df)), _POSITION)

    if join.static:  # broadcast history: the join is part of the stream's plan, built once
        source = enrich(features)

        def sink(batch: DataFrame, batch_id: int) -> None:
            write_batch(batch, sink_path, batch_id)

    else:  # skew split (counts each batch's keys) or reloaded history: built per batch
        source = features

        def sink(batch: DataFrame, batch_id: int) -> None:
            join.prepare(batch_id)
            write_batch(enrich(batch), sink_path, batch_id)

    writer = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


_COMPLETE = "_complete"
_POSITION = ("partition", "offset")  # where a record came from: no model input, may be NULL


def scoring_frame(
    decoded: DataFrame, join, scorer: Callable[[DataFrame], DataFrame], label: str = "isBotEdit"
) -> DataFrame:
    """Every decoded row with its edit (``_edit``, NULL for a reject), the model inputs, the
    history count, ``_complete`` and ``predicted``: one plan, declared once, valid on a stream.

    ``join`` must be a plain per-row join (the broadcast history). Rows that would be dropped
    before scoring (rejects, NULL inputs) go through the model with zeros in place of their
    inputs and are filtered out by ``_complete`` at the sink, so the assembler's NULL check
    still holds and no row of the scored table differs from scoring the complete rows alone.
    """
    tagged = tag_edits(decoded)
    edits = tagged.select(*decoded.columns, "_edit", "_edit.*")
    features = feat.feature_rows(edits, keep=[*decoded.columns, "_edit"])
    model = feat.fill_missing_history(join(features))
    complete = F.col("_edit").isNotNull()
    for c in ["user", *feat.FEATURES, label]:
        complete = complete & F.col(c).isNotNull()
    masked = model.withColumn(_COMPLETE, complete).select(
        *[
            F.when(F.col(_COMPLETE), F.col(c)).otherwise(F.lit(0)).alias(c) if c in feat.FEATURES else F.col(c)
            for c in model.columns
        ],
        _COMPLETE,
    )
    return scorer(masked)


def _dealt(records: DataFrame, tasks: int) -> DataFrame:
    """Records dealt by position over ``tasks``, by a hash of their own: a file of a topic that was cut by
    the plain hash of (partition, offset) holds one remainder of it and would fill few of the tasks."""
    return records.repartition(tasks, F.xxhash64("partition", "offset"))


def start_scoring(
    records: DataFrame,
    history: DataFrame | Callable[[], DataFrame],
    scorer: Callable[[DataFrame], DataFrame],
    paths: dict[str, str],
    checkpoint: str,
    trigger: dict | None = None,
    label: str = "isBotEdit",
    reload_every: int = 0,
    after_sink: Callable[[str, int], None] | None = None,
    spread: int | None = None,
) -> StreamingQuery:
    """Per micro-batch: raw table, scored table and batch metrics, each idempotent per batch.

    ``scorer`` maps the model frame (features + no_of_edits) to the same rows plus an integer
    ``predicted`` column. Each row is parsed and scored once: the batch is persisted and feeds
    the raw, reject and scored sinks, and the metrics are observed during the scored write and
    logged. ``paths`` has keys ``raw`` and ``scored``, and optionally ``metrics`` (a table of
    per-batch metrics), ``rejects`` (malformed JSON keeps its text in ``_corrupt_record``) and
    ``commits``: a folder of markers, one written when all of a batch's sinks are complete.
    Readers that go through ``commits.read_committed`` never see a batch that is in some sinks only.
    ``after_sink(name, batch_id)`` is called when a sink has its batch. ``spread`` deals a batch's
    rows over that many tasks before they are parsed and scored, for topics with fewer partitions
    than the job has cores.

    When the history fits the broadcast bound, parse, features, join and model are declared
    once on the stream (``scoring_frame``), so a micro-batch builds no plan in Python and only
    selects its outputs. Above the bound each batch runs the hot-key split join, which needs
    a count of the batch, so that part of the plan is built per batch; so it is when
    ``history`` is a loader function read again every ``reload_every`` batches.
    """
    if spread:
        records = _dealt(records, spread)
    decoded = decode_raw(records)
    join = _history_joiner(history, reload_every=reload_every)
    out_cols = ["partition", "offset", "user", *feat.FEATURES, label]
    predicted = F.col("predicted").cast("int").alias("predicted")

    done = after_sink or (lambda name, batch_id: None)

    def write_outputs(edits: DataFrame, rejects: DataFrame, scored: DataFrame, batch_id: int) -> None:
        write_raw_table(edits, paths["raw"], batch_id)
        done("raw", batch_id)
        if "rejects" in paths:
            write_batch(rejects, paths["rejects"], batch_id)
            done("rejects", batch_id)
        # Metrics are observed while the scored rows are written (no second job over them).
        seen = Observation(f"scored_{batch_id}")
        wrong = F.col(label) != F.col("predicted")
        write_scored_table(
            scored.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("errors")),
            paths["scored"],
            batch_id,
        )
        done("scored", batch_id)
        got = seen.get
        rows, errors = int(got["rows"]), int(got["errors"])
        rate = round(errors / rows, 6) if rows else None
        LOG.info("batch %d: %d scored rows, %d errors, error rate %s", batch_id, rows, errors, rate)
        if "metrics" in paths:
            # One row made in the JVM: a local Python table would start Python workers in every batch.
            metrics = scored.sparkSession.range(0, 1, 1, 1).select(
                F.lit(int(batch_id)).cast("long").alias("batch_id"), F.current_timestamp().alias("batch_time"),
                F.lit(rows).cast("long").alias("rows"), F.lit(errors).cast("long").alias("errors"),
                F.lit(rate).cast("double").alias("error_rate"))
            write_batch(metrics, paths["metrics"], batch_id)
            done("metrics", batch_id)
        if "commits" in paths:
            commits.mark(scored.sparkSession, paths["commits"], batch_id)

    if join.static:
        wide = scoring_frame(decoded, join, scorer, label)
        has_edit = F.col("_edit").isNotNull()

        def process(batch: DataFrame, batch_id: int) -> None:
            kept = batch.persist()
            try:
                write_outputs(
                    kept.where(has_edit).select("_edit.*"),
                    kept.where(~has_edit).select(*decoded.columns),
                    kept.where(F.col(_COMPLETE)).select(*out_cols, predicted),
                    batch_id,
                )
            finally:
                kept.unpersist()

        source = wide
    else:

        def process(batch: DataFrame, batch_id: int) -> None:
            join.prepare(batch_id)
            # One regex pass per row: the tagged batch (edit struct or NULL) is kept for the sinks.
            tagged = tag_edits(batch).persist()
            try:
                edits = edits_from_tagged(tagged)
                features = feat.feature_rows(edits, keep=["partition", "offset"])
                model = feat.drop_incomplete(feat.fill_missing_history(join(features)), _POSITION)
                scored = scorer(model).select(*out_cols, predicted)
                write_outputs(edits, rejects_from_tagged(tagged), scored, batch_id)
            finally:
                tagged.unpersist()

        source = decoded

    writer = source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def copy_topic(records: DataFrame, topic_path: str, checkpoint: str, topic: str, trigger: dict | None = None) -> StreamingQuery:
    """Mirror / replay a topic into another one, keeping key, value, partition and offset."""
    out = records.withColumn("topic", F.lit(topic))
    writer = out.writeStream.format("json").option("path", topic_path).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def text_to_topic(
    lines: DataFrame, topic_path: str, checkpoint: str, topic: str, trigger: dict | None = None, partitions: int = 4
) -> StreamingQuery:
    """Text file source -> topic records (no key, value = line).

    A file's lines go to one partition (a hash of its path), in order; offsets rise within a
    partition. They are the batch number over the line's place among the batch's lines by file,
    split and position, so a batch that is replayed gives every line the same offset.
    """
    placed = lines.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        line = batch.withColumn("_line", F.monotonically_increasing_id())
        numbered = joins.row_index(line, ["_file", "_start", "_line"], "_at")
        write_batch(
            numbered.select(
                F.lit(None).cast("string").alias("key"),
                "value",
                F.lit(topic).alias("topic"),
                F.pmod(F.xxhash64("_file"), F.lit(partitions)).cast("int").alias("partition"),
                (F.lit(int(batch_id) << 40) + F.col("_at")).alias("offset"),
                F.current_timestamp().alias("timestamp"),
            ),
            topic_path, batch_id, fmt="json",
        )

    writer = placed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def topic_to_text(records: DataFrame, text_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Topic -> text file sink (one line per record value)."""
    writer = (
        records.select("value").writeStream.format("text")
        .option("path", text_path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start()


def start_console(df: DataFrame, rows: int = 20, output_mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Print each micro-batch on the driver console (at most ``rows`` rows per batch)."""
    writer = df.writeStream.format("console").outputMode(output_mode).option("numRows", rows).option("truncate", "false")
    return _trigger(writer, trigger).start()


def start_changelog_lines(
    edits: DataFrame,
    path: str | None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The per-user counts as a stream of ``USER: <u> num.edits: <n>`` lines, one per change.

    With ``path`` each batch's lines go to ``path/batch_id=<n>`` as text (replay-safe); without
    one they are printed on the console.
    """
    use_rocksdb_state(edits.sparkSession)
    lines = agg.changelog_text(agg.edits_by_user(edits))
    if path is None:
        return start_console(lines, output_mode="update", trigger=trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, fmt="text")

    writer = lines.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def source_lag(query: StreamingQuery) -> list[dict]:
    """Live reader lag of a running query, from its last progress report: per source, the
    offsets it has read up to and the latest offsets available."""
    progress = query.lastProgress or {}
    return [
        {
            "source": src.get("description"),
            "end_offset": src.get("endOffset"),
            "latest_offset": src.get("latestOffset"),
            "input_rows": src.get("numInputRows"),
        }
        for src in progress.get("sources", [])
    ]


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query, however long it takes; fail loudly if it errored.

    Only an explicit ``timeout_s`` stops a query that is still working.
    """
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination() or True
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


AVAILABLE_NOW = {"availableNow": True}

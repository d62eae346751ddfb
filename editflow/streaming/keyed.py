"""Streams that continue by key: a topic dealt by the key's hash, and one change for each record."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from editflow.functions.murmur import key_partition
from editflow.operators import joins
from editflow.operators.aggregates import running_count
from editflow.operators.parse import only_edits
from editflow.operators.topics import encode_parsed
from editflow.sources import store
from editflow.sources.files import write_batch
from editflow.streaming import commits
from editflow.streaming.pipeline import _trigger, raw_to_edits
from editflow.streaming.tables import SnapshotTable

ENDS = "_ends"  # next offset of every partition after each batch
KEEP_ENDS = 20


def next_offsets(spark, topic_path: str, before: int | None = None) -> dict[int, int]:
    """Next offset of each partition of a keyed topic (as of before batch ``before``)."""
    found = [int(n) for n in store.names(spark, f"{topic_path}/{ENDS}")]
    found = [n for n in found if before is None or n < before]
    if not found:
        return {}
    ends = json.loads(store.text(spark, f"{topic_path}/{ENDS}/{max(found):012d}"))
    return {int(p): int(n) for p, n in ends.items()}


def append_keyed(records: DataFrame, topic_path: str, batch_id: int, topic: str, partitions: int) -> None:
    """Append records (key, value, timestamp, source partition and offset) dealt by their key's hash.

    Offsets continue each partition's without a gap, in the order of the source partition and offset.
    They start from the ends written by the batch before, so a batch that is replayed gives each of its
    records the same place. Records without a key are dealt by their source offset. A batch is numbered
    by a range split (``running_count``): a partition that gets most of a batch is not one task.
    """
    spark = records.sparkSession
    at = F.coalesce(key_partition(F.col("key"), partitions), F.pmod(F.col("offset"), F.lit(partitions)).cast("int"))
    dealt = records.select(
        "key", "value", "timestamp", at.alias("to"), F.col("partition").alias("_source"), F.col("offset").alias("_at"))
    numbered = running_count(dealt, key="to", order=("_source", "_at"))
    start = next_offsets(spark, topic_path, before=batch_id)
    base = F.create_map(*[F.lit(x) for p in range(partitions) for x in (p, start.get(p, 0))])
    out = numbered.select(
        "key", "value", F.lit(topic).alias("topic"), F.col("to").alias("partition"),
        (F.element_at(base, F.col("to")) + F.col("num_edits") - 1).alias("offset"), "timestamp")
    write_batch(out, topic_path, batch_id, fmt="json")
    grown = {r["to"]: r["n"] for r in numbered.groupBy("to").agg(F.max("num_edits").alias("n")).collect()}  # one row a partition
    ends = {p: start.get(p, 0) + grown.get(p, 0) for p in range(partitions)}
    store.put(spark, f"{topic_path}/{ENDS}/{int(batch_id):012d}", json.dumps(ends))
    for old in store.names(spark, f"{topic_path}/{ENDS}")[:-KEEP_ENDS]:
        store.remove(spark, f"{topic_path}/{ENDS}/{old}")


def start_keyed_topic(
    records: DataFrame, topic_path: str, checkpoint: str, partitions: int = 4, topic: str = "edits-parsed",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Raw topic -> parsed topic whose records lie by their user's hash, as behind a broker: key = user,
    value = edit JSON, and dense offsets in each partition across micro-batches and restarts.

    What reads this topic finds all edits of a user in one partition, in order.
    """
    edits = encode_parsed(raw_to_edits(records).drop("key")).select(
        "key", "value", "partition", "offset", F.col("record_ts").alias("timestamp"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        append_keyed(batch, topic_path, batch_id, topic, partitions)

    writer = edits.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def start_running_changelog(
    edits: DataFrame, path: str, checkpoint: str, order: tuple[str, ...] = ("record_ts", "partition", "offset"),
    trigger: dict | None = None, buckets: int = 32, fold_every: int = 8,
) -> StreamingQuery:
    """The running count as a stream of changes: one row for each edit with its user's count after it.

    Per batch: edits are numbered within their user (range-split, so a hot user is not one task), the
    counts before the batch come from the keyed table of the batches before, and both are added. The
    changes go to ``path/changes/batch_id=<n>``, the table to ``path/table`` (``SnapshotTable``), and
    the batch counts once both are written. A replay reads the table as it was before the batch.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = SnapshotTable(spark, f"{path}/table", buckets=buckets, fold_every=fold_every)
        keep = list(dict.fromkeys(["user", "partition", "offset", *order]))
        numbered = running_count(only_edits(batch).select(*keep), key="user", order=order)
        now = numbered.groupBy("user").agg(F.max("num_edits").alias("grown"))
        before = table.read(before=batch_id)
        if before is None:
            before = now.select("user", F.lit(0).cast("long").alias("num_edits")).limit(0)
        # One row for each user of the batch: what it had before.
        held = now.join(before.withColumnRenamed("num_edits", "had"), "user", "left").select(
            "user", F.coalesce("had", F.lit(0)).alias("had"), "grown").checkpoint()
        joined = (numbered.join(F.broadcast(held), "user", "left") if joins.fits_broadcast(held)
                  else joins.skew_split_left_join(numbered, held, "user"))
        write_batch(joined.select(*keep, (F.col("had") + F.col("num_edits")).alias("num_edits")), f"{path}/changes", batch_id)
        table.write(held.select("user", (F.col("had") + F.col("grown")).alias("num_edits")), batch_id)
        table.commit(batch_id)

    writer = edits.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def read_changes(spark, path: str) -> DataFrame:
    """The changes of complete batches."""
    return commits.read_committed(spark, f"{path}/changes", f"{path}/table/_commits")


def start_append_if_absent(
    rows: DataFrame, existing: DataFrame, path: str, checkpoint: str, key: str = "user",
    order: tuple[str, ...] = ("partition", "offset"), trigger: dict | None = None, buckets: int = 32, fold_every: int = 8,
) -> StreamingQuery:
    """Append under a unique key: a record is stored only if its key is neither in ``existing`` nor came before.

    The keyed table is the state. It starts from ``existing`` (taken once, when the query first
    starts) and each batch adds the first row in ``order`` of every key that it lacks. Rows are reduced
    to one for each key before the shuffle, so a key with most of a batch moves one row a task, and nothing
    is kept beside the table. A replay compares with the table as it was before the batch.
    ``read_appended`` gives the appended rows.
    """
    spark = rows.sparkSession
    values = [c for c in rows.columns if c != key]
    row = F.struct(*values)
    kind = rows.select(row.alias("r")).schema["r"].dataType
    table = SnapshotTable(spark, path, key=key, value="row", buckets=buckets, fold_every=fold_every)
    table.seed(existing.where(F.col(key).isNotNull()).select(key).distinct().withColumn("row", F.lit(None).cast(kind)))

    def sink(batch: DataFrame, batch_id: int) -> None:
        here = SnapshotTable(batch.sparkSession, path, key=key, value="row", buckets=buckets, fold_every=fold_every)
        first = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(row, F.struct(*order)).alias("row"))
        held = here.read(before=batch_id)
        here.write(first if held is None else first.join(held.select(key), key, "left_anti"), batch_id)
        here.commit(batch_id)

    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def read_appended(spark, path: str, key: str = "user") -> DataFrame:
    """The rows appended by complete batches, without those that the table started from."""
    table = SnapshotTable(spark, path, key=key, value="row").read()
    return table.where("row is not null").select(key, "row.*")

"""Keyed topics, per-record changes, snapshots, complete batches and committed positions."""

import struct

import pytest
from pyspark.sql import functions as F

from editflow.functions.murmur import key_partition, murmur2
from editflow.operators import aggregates as agg
from editflow.plans import keyed as Q
from editflow.plans.catalog import history, parsed, rule_prediction
from editflow.plans.streams import raw_topic_records
from editflow.sources import store
from editflow.sources.topics import read_topic, write_topic
from editflow.streaming import commits, keyed, positions
from editflow.streaming import pipeline as P
from editflow.streaming.tables import SnapshotTable

SF = "/root/testdata/sf0.001"


def plain_murmur2(data: bytes) -> int:
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    for k in range(0, len(data) // 4 * 4, 4):
        w = struct.unpack_from("<I", data, k)[0] * m & mask
        h = (h * m & mask) ^ ((w ^ w >> 24) * m & mask)
    rest = data[len(data) // 4 * 4:]
    if rest:
        h = (h ^ int.from_bytes(rest, "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


def test_murmur2(spark):
    keys = ["", "a", "ab", "abc", "abcd", "user12", "Straße", "日本語", "x" * 101, "21", "foobar", "\U0001f600 ok", None]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", murmur2(F.col("k")), key_partition(F.col("k"), 7)).collect()
    for k, h, p in got:
        want = None if k is None else plain_murmur2(k.encode())
        assert h == want and p == (None if k is None else (want & 0x7FFFFFFF) % 7), k
    assert plain_murmur2(b"21") == -973932308 & 0xFFFFFFFF and plain_murmur2(b"foobar") == -790332482 & 0xFFFFFFFF


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_keyed_topic_replay_keeps_places(spark, scratch):
    topic, checkpoint = scratch("keyed"), scratch("ckpt")
    run = lambda raw: P.run_to_end(keyed.start_keyed_topic(raw, topic, checkpoint, 3, trigger=P.AVAILABLE_NOW))
    raw = Q.staged_runs(spark, SF, Q.by_source, run)
    first = _rows(read_topic(spark, topic))
    ends = keyed.next_offsets(spark, topic)
    store.remove(spark, f"{checkpoint}/commits/3")  # the last batch is run again
    run(read_topic(spark, raw, stream=True))
    assert _rows(read_topic(spark, topic)) == first and keyed.next_offsets(spark, topic) == ends
    spans = read_topic(spark, topic).groupBy("partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.count_distinct("offset").alias("n")).collect()
    assert len(spans) == 3 and all(s.low == 0 and s.high + 1 == s.n == ends[s.partition] for s in spans)
    # A user's edits lie in one partition, and a later query goes on from there.
    assert read_topic(spark, topic).groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").isEmpty()


def test_records_without_key_and_empty_batch(spark, scratch):
    topic = scratch("keyed")
    rows = [(None, "v", 0, k, None) for k in range(6)] + [("u", "w", 1, 0, None)]
    records = spark.createDataFrame(rows, "key string, value string, partition int, offset long, timestamp timestamp")
    keyed.append_keyed(records, topic, 0, "t", 3)
    keyed.append_keyed(records.limit(0), topic, 1, "t", 3)
    keyed.append_keyed(records, topic, 2, "t", 3)
    out = read_topic(spark, topic)
    assert out.count() == 14 and out.select("partition", "offset").distinct().count() == 14
    assert sum(keyed.next_offsets(spark, topic).values()) == 14


def test_running_changelog_replay_and_hot_user(spark, scratch):
    out, checkpoint = scratch("changes"), scratch("ckpt")
    hot = raw_topic_records(spark, SF).withColumn("value", F.regexp_replace("value", r"\* user[0-9]*[02468] \*", "* user0 *"))
    topic = scratch("topic")
    run = lambda: P.run_to_end(keyed.start_running_changelog(
        P.raw_to_edits(read_topic(spark, topic, stream=True)), out, checkpoint, trigger=P.AVAILABLE_NOW, fold_every=2))
    for k in range(4):
        write_topic(hot.where(F.col("partition") == k), topic)
        run()
    edits = P.raw_to_edits(hot)
    want = sorted((r.user, r.partition, r.offset, r.num_edits) for r in agg.running_count(
        agg.only_edits(edits).select("user", "partition", "offset"), order=("partition", "offset")).collect())
    seen = lambda: sorted((r.user, r.partition, r.offset, r.num_edits) for r in keyed.read_changes(spark, out).collect())
    assert seen() == want
    store.remove(spark, f"{checkpoint}/commits/3")
    run()
    assert seen() == want
    table = SnapshotTable(spark, f"{out}/table").read()
    assert sorted(table.select("user", "num_edits").collect()) == sorted(agg.edits_by_user(edits).collect())


def test_snapshot_reads_snapshot_and_one_batch(spark, scratch):
    table = SnapshotTable(spark, scratch("table"), buckets=5)
    want = {}
    for batch in range(7):
        changes = {f"u{k}": 100 * batch + k for k in range(batch, 40, batch + 1)}
        want.update(changes)
        df = spark.createDataFrame(list(changes.items()), "user string, num_edits long")
        for _ in range(1 + batch % 2):  # every second batch is written twice
            table.write(df, batch)
        assert table.read(before=batch) is None or dict(map(tuple, table.read(before=batch).collect())) != {}
        table.commit(batch)
        assert dict(map(tuple, table.read().collect())) == want
    files = [f for f in table.read().inputFiles() if "batch_id=" in f]
    assert files and all("batch_id=6/" in f for f in files)
    assert len(store.names(spark, f"{table.path}/_manifest")) <= 3
    table.fold(3)  # older than the snapshot: nothing changes
    assert dict(map(tuple, table.read().collect())) == want
    # A batch without its marker is not seen.
    table.write(spark.createDataFrame([("u1", -1)], "user string, num_edits long"), 7)
    assert dict(map(tuple, table.read().collect())) == want


def test_fold_interrupted_before_its_manifest(spark, scratch, monkeypatch):
    table = SnapshotTable(spark, scratch("table"), buckets=3)
    for batch in range(2):
        table.write(spark.createDataFrame([("a", batch), (f"b{batch}", 1)], "user string, num_edits long"), batch)
        table.commit(batch)
    with monkeypatch.context() as m:
        m.setattr(store, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.fold(1)
    assert dict(map(tuple, table.read().collect())) == {"a": 1, "b0": 1, "b1": 1}
    table.fold(1)
    assert dict(map(tuple, table.read().collect())) == {"a": 1, "b0": 1, "b1": 1}


def test_readers_see_no_half_batch(spark, scratch):
    """Whatever sink a batch fails after, the complete batches show every sink up to the same batch."""
    past = history(spark, SF)
    for sink in ("raw", "rejects", "scored", "metrics"):
        base, checkpoint, topic = scratch("score"), scratch("ckpt"), scratch("topic")
        paths = {k: f"{base}/{k}" for k in ("raw", "scored", "metrics", "rejects", "commits")}
        write_topic(raw_topic_records(spark, SF), topic, files=1)

        def fail(name, batch_id):
            if name == sink:  # noqa: B023
                raise RuntimeError("stop here")

        start = lambda hook: P.start_scoring(
            read_topic(spark, topic, stream=True), past, rule_prediction, paths, checkpoint, P.AVAILABLE_NOW, after_sink=hook)  # noqa: B023
        with pytest.raises(Exception, match="stop here"):
            P.run_to_end(start(fail))
        assert commits.last(spark, paths["commits"]) == -1
        assert commits.read_committed(spark, paths["raw"], paths["commits"]).isEmpty()
        P.run_to_end(start(None))
        n = parsed(spark, SF).count()
        assert commits.read_committed(spark, paths["raw"], paths["commits"]).count() == n
        assert commits.read_committed(spark, paths["scored"], paths["commits"]).count() == n


def test_markers_are_bounded(spark, scratch):
    folder = scratch("commits")
    assert commits.last(spark, folder) == -1
    for k in range(30):
        commits.mark(spark, folder, k)
    commits.mark(spark, folder, 29)
    assert commits.last(spark, folder) == 29 and len(store.names(spark, folder)) == commits.KEEP


def test_positions(spark, scratch):
    topic, checkpoint, out = scratch("topic"), scratch("ckpt"), scratch("out")
    records = raw_topic_records(spark, SF)
    assert positions.committed_batch(spark, checkpoint) == -1
    assert positions.committed_files(spark, checkpoint).isEmpty()
    for k in range(12):  # past the source log's compaction
        write_topic(records.where((F.col("partition") == k % 4) & (F.floor(F.col("offset") / 70) == k // 4)), topic)
        P.run_to_end(P.copy_topic(read_topic(spark, topic, stream=True), out, checkpoint, "copy", P.AVAILABLE_NOW))
    assert positions.committed_batch(spark, checkpoint) == positions.planned_batch(spark, checkpoint) == 11
    got = {r.partition: r.committed_offset for r in positions.file_positions(read_topic(spark, topic), checkpoint).collect()}
    assert got == {p: 210 for p in range(4)}
    # The form of a source that keeps an offset for each partition.
    store.put(spark, f"{checkpoint}/offsets/11", 'v1\n{}\n{"edits-raw":{"0":17,"1":4}}\n{"logOffset":3}\n')
    got = [tuple(r) for r in positions.broker_positions(spark, checkpoint).orderBy("partition").collect()]
    assert got == [(0, "edits-raw", 0, 17), (0, "edits-raw", 1, 4)]

"""Keyed tables kept up to date by micro-batches, read without their old changes.

Each batch writes its changes (key, value after the batch) to ``path/batch_id=<n>``. ``fold`` merges
them into a snapshot, cut into buckets by a hash of the key: only buckets with a change are written, as
a new version beside the old one (``_snapshot/bucket=<b>/upto=<n>``, dynamic partition overwrite), and a
manifest of one small file then names the version of every bucket. A reader takes the manifest, the
versions it names and the complete batches after it, so nothing that it reads is ever rewritten.

Values are those after the batch and not increments, so folding or replaying a batch twice changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.sources import store
from editflow.sources.files import write_batch
from editflow.streaming import commits


class SnapshotTable:
    """The current value of each key, from a snapshot and the changes since.

    ``fold_every`` is the number of batches between two folds: 1 reads one batch beside the snapshot
    but rewrites every touched bucket each time; larger numbers write less and read that many batches.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "user", value: str = "num_edits",
                 buckets: int = 32, fold_every: int = 1):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.value, self.buckets, self.fold_every = key, value, buckets, fold_every

    @property
    def commits(self) -> str:
        return f"{self.path}/_commits"

    def _manifest(self, before: int | None = None) -> dict:
        """The latest manifest (of a state before batch ``before``)."""
        found = [int(n) for n in store.names(self.spark, f"{self.path}/_manifest")]
        found = [n for n in found if before is None or n < before]
        if not found:
            return {"upto": -1, "versions": {}, "buckets": self.buckets}
        return json.loads(store.text(self.spark, f"{self.path}/_manifest/{max(found):012d}"))

    def _bucket(self, buckets: int) -> F.Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int").alias("bucket")

    def _changes(self, after: int, upto: int) -> DataFrame | None:
        there = {n for n in store.names(self.spark, self.path) if n.startswith("batch_id=")}
        paths = [f"{self.path}/batch_id={n}" for n in range(after + 1, upto + 1) if f"batch_id={n}" in there]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.path).parquet(*paths).select(
            self.key, self.value, F.col("batch_id").cast("long").alias("batch_id"))

    def _snapshot(self, versions: dict[str, int]) -> DataFrame | None:
        if not versions:
            return None
        root = f"{self.path}/_snapshot"
        paths = [f"{root}/bucket={b}/upto={v}" for b, v in versions.items()]
        return self.spark.read.option("basePath", root).parquet(*paths).select(self.key, self.value, "batch_id")

    def _latest(self, rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by, self.key).agg(
            F.max_by(self.value, "batch_id").alias(self.value), F.max("batch_id").alias("batch_id"))

    def fold(self, upto: int) -> None:
        """Merge the changes up to batch ``upto`` into the snapshot. Doing it again does nothing new."""
        old = self._manifest()
        changes = self._changes(old["upto"], upto) if upto > old["upto"] else None
        if changes is None:
            return
        bucket = self._bucket(old["buckets"])
        touched = sorted(r["bucket"] for r in changes.select(bucket).distinct().collect())  # at most all buckets
        held = self._snapshot({b: old["versions"][str(b)] for b in touched if str(b) in old["versions"]})
        rows = changes if held is None else changes.unionByName(held)
        # One shuffle: rows dealt by bucket are also together by (bucket, key).
        dealt = rows.select("*", bucket).repartition(max(1, len(touched)), "bucket")
        merged = self._latest(dealt, "bucket").withColumn("upto", F.lit(int(upto)))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "upto").parquet(
            f"{self.path}/_snapshot")
        versions = {**old["versions"], **{str(b): int(upto) for b in touched}}
        store.put(self.spark, f"{self.path}/_manifest/{int(upto):012d}",
                  json.dumps({"upto": int(upto), "versions": versions, "buckets": old["buckets"]}))
        self._drop_old(versions)

    def _drop_old(self, versions: dict[str, int]) -> None:
        """Manifests but the latest three, and versions that none of them names."""
        kept = store.names(self.spark, f"{self.path}/_manifest")
        for name in kept[:-3]:
            store.remove(self.spark, f"{self.path}/_manifest/{name}")
        manifests = [json.loads(store.text(self.spark, f"{self.path}/_manifest/{n}")) for n in kept[-3:]]
        for b in versions:
            named = {f"upto={m['versions'][b]}" for m in manifests if b in m["versions"]}
            for version in store.names(self.spark, f"{self.path}/_snapshot/bucket={b}"):
                if version not in named:
                    store.remove(self.spark, f"{self.path}/_snapshot/bucket={b}/{version}")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """One batch: earlier batches are folded when their turn has come, then the changes are written.

        ``commit`` publishes the batch; until then no reader sees it.
        """
        if batch_id > 0 and (batch_id % self.fold_every) == 0:
            self.fold(batch_id - 1)
        write_batch(changes.select(self.key, self.value), self.path, batch_id)

    def seed(self, rows: DataFrame) -> None:
        """Start from an existing table of (key, value), one row for each key, as if written before batch
        0. A table that has been started keeps what it has."""
        if store.names(self.spark, f"{self.path}/_manifest") or commits.last(self.spark, self.commits) >= 0:
            return
        dealt = rows.select(self.key, self.value, F.lit(-1).cast("long").alias("batch_id"), self._bucket(self.buckets))
        dealt.withColumn("upto", F.lit(-1)).repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy(
            "bucket", "upto").parquet(f"{self.path}/_snapshot")
        there = [n.split("=")[1] for n in store.names(self.spark, f"{self.path}/_snapshot") if n.startswith("bucket=")]
        store.put(self.spark, f"{self.path}/_manifest/{-1:012d}",
                  json.dumps({"upto": -1, "versions": dict.fromkeys(there, -1), "buckets": self.buckets}))

    def commit(self, batch_id: int) -> None:
        commits.mark(self.spark, self.commits, batch_id)

    def read(self, before: int | None = None) -> DataFrame | None:
        """(key, value) now, or as it was before batch ``before``; None if there is nothing yet."""
        upto = commits.last(self.spark, self.commits)
        if before is not None:
            upto = min(upto, before - 1)
        manifest = self._manifest(None if before is None else before)
        held, changes = self._snapshot(manifest["versions"]), self._changes(manifest["upto"], upto)
        rows = changes if held is None else held if changes is None else held.unionByName(changes)
        return None if rows is None else self._latest(rows).drop("batch_id")


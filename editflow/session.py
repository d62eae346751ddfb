"""Session construction and the shared scratch location.

Lineage cuts, streaming checkpoints and intermediate tables all live under the folder the
cluster names in ``spark.checkpoint.dir``. That folder must be shared storage on a cluster,
so it is only ever *read* from the session; a machine-local folder is created solely when the
setting is absent and Spark runs in local mode (tests, benchmarks on one machine).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every editflow session wants. AQE re-plans joins and coalesces partitions at
# runtime from real map-output sizes; skew-join splitting handles hot users in shuffle joins.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of lineage cuts (row index) are removed once no plan references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Per-user counts grow without bound (one row per user ever seen): RocksDB keeps that
    # state off-heap and changelog checkpointing uploads only the delta of each batch.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "editflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with editflow's defaults.

    ``master=None`` leaves the master to ``spark-submit``. ``shuffle_partitions`` overrides the
    cluster's own setting only where it is given; AQE coalesces small partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only for local mode.

    Resolved once per SparkContext (the setting is fixed for its lifetime) and remembered on it.
    """
    sc = spark.sparkContext
    known = getattr(sc, "_editflow_checkpoint_root", None)
    if known:
        return known
    sc._editflow_checkpoint_root = _resolve_checkpoint_root(sc)
    return sc._editflow_checkpoint_root


def _resolve_checkpoint_root(sc) -> str:
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        current = sc.getCheckpointDir()
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    local = tempfile.mkdtemp(prefix="editflow-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"

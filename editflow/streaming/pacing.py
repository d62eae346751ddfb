"""A log of how a stream keeps its pace: one row for each micro-batch, with its duration and delay.

A listener receives the progress of every batch and writes it under the shared folder, some hundred rows
to a small file, so that a run of weeks leaves a bounded number of files. The log is a table.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from editflow.sources import store

ROWS_OF_A_FILE = 500
PACE = ("query string, run string, batch_id long, started timestamp, input_rows long, duration_ms long, "
        "interval_ms long, delay_ms long")


class PaceLog(StreamingQueryListener):
    """Logs every batch of the session's queries to ``path``; ``interval_ms`` is the trigger's interval.

    ``delay_ms`` is by how much a batch took longer than the interval, which the next one starts late by.
    Triggers without data are not logged.
    """

    def __init__(self, spark: SparkSession, path: str, interval_ms: int = 2000):
        self.spark, self.path, self.interval_ms = spark, path, interval_ms
        self.rows: dict[tuple[str, int], list[dict]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self.rows = {k: v for k, v in self.rows.items() if k[0] != run}

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        took = int(p.durationMs.get("triggerExecution", 0))
        key = (str(p.runId), int(p.batchId) // ROWS_OF_A_FILE)
        rows = self.rows.setdefault(key, [])
        rows.append({
            "query": str(p.id), "run": key[0], "batch_id": int(p.batchId), "started": p.timestamp, "input_rows": int(p.numInputRows),
            "duration_ms": took, "interval_ms": self.interval_ms, "delay_ms": max(0, took - self.interval_ms)})
        store.put(self.spark, f"{self.path}/{key[0]}-{key[1]:08d}.json", "\n".join(map(json.dumps, rows)) + "\n")
        self.rows = {k: v for k, v in self.rows.items() if k[0] != key[0] or k[1] >= key[1]}  # full files are done


def read_pace(spark: SparkSession, path: str) -> DataFrame:
    """(query, run, batch_id, started, input_rows, duration_ms, interval_ms, delay_ms)."""
    rows = spark.read.schema(PACE.replace("started timestamp", "started string")).json(path)
    return rows.withColumn("started", F.to_timestamp("started"))


def run_paced(query: StreamingQuery, log: PaceLog, wait_s: float = 30.0) -> None:
    """Let a paced query work off what its sources hold, stop it, and wait until its last batch is logged.

    Progress reaches listeners a moment after the batch; ``wait_s`` bounds that wait only.
    """
    run = str(query.runId)
    query.processAllAvailable()
    done = [p["batchId"] for p in query.recentProgress if p["numInputRows"]]
    end = time.monotonic() + wait_s
    while done and time.monotonic() < end:
        if any(r["batch_id"] == done[-1] for (of, _), rows in log.rows.items() if of == run for r in rows):
            break
        time.sleep(0.05)
    query.stop()

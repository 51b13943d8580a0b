"""A durable record of what every micro-batch did, with the rows dropped as late.

A streaming query keeps its last hundred progress reports and forgets the
rest. ``ProgressLog`` listens to all of them and writes them as small JSON
files, ``flush_every`` reports each (and the rest when a query ends), so the
record outlives the query, the driver and a restart. A batch that ran twice
(after a restart) is counted once, by its last report.
"""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ridepulse.sources import files

PROGRESS_SCHEMA = (
    "query string, id string, run_id string, batch_id long, at string, input_rows long, dropped_rows long, "
    "state_rows long, watermark string"
)


class ProgressLog(StreamingQueryListener):
    """Register with ``attach``; ``detach`` writes what is still held."""

    def __init__(self, spark: SparkSession, folder: str, flush_every: int = 50):
        self.spark, self.folder, self.flush_every = spark, folder.rstrip("/"), flush_every
        self.held: list[dict] = []
        self.ended: set[str] = set()
        self.lock = threading.Lock()

    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "query": p.name,
            "id": str(p.id),
            "run_id": str(p.runId),
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            "dropped_rows": sum(op.numRowsDroppedByWatermark for op in p.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in p.stateOperators),
            "watermark": (p.eventTime or {}).get("watermark"),
        }
        with self.lock:
            self.held.append(row)
            full = len(self.held) >= self.flush_every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended.add(str(event.runId))

    def flush(self) -> None:
        with self.lock:
            if not self.held:
                return
            name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
            text = "".join(json.dumps(row) + "\n" for row in self.held)
            files.create(self.spark, f"{self.folder}/{name}", text)
            self.held.clear()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Reports come after the batch they tell of; wait until those of an ended query are written."""
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no end of query {query.name} reported in {seconds} s")
            time.sleep(0.05)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """One row per query and batch: the last report."""
    rows = spark.read.schema(PROGRESS_SCHEMA).json(folder)
    keys = ["query", "id", "batch_id"]
    values = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "at").alias("last"))
    return last.select(*keys, "last.*")


def late_rows(progress: DataFrame) -> DataFrame:
    """Per query: batches with input, rows read, and rows its stateful operators dropped behind the watermark.

    Late rows are counted where they are dropped, after the partial aggregate:
    rows of one group and task are one.
    """
    return progress.groupBy("query").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"),
    )

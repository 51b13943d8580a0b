"""The three streaming aggregations over one cleaned trip stream.

Each ``start_*`` builds the aggregate with the same function the batch path
uses (``ridepulse.operators.running``) and starts one ``StreamingQuery`` with
its own checkpoint. Output goes through ``foreachBatch`` so the result is a
table on shared storage, saved every micro-batch (not only at shutdown).
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ridepulse.operators import running
from ridepulse.operators.clean import clean_stream
from ridepulse.schema import ZONE_LATENESS, ZONE_WINDOW
from ridepulse.streaming.sinks import KeyedUpdateSink, SnapshotSink


# With several watermarks in a stream the slowest one counts: no feed makes another's rows late.
WATERMARK_POLICY = {"spark.sql.streaming.multipleWatermarkPolicy": "min"}
# Keys of the update-mode results.
ZONE_KEYS = ["window_start", "window_end", "PULocationID"]
DAY_KEYS = ["trip_date"]


@dataclass
class Trigger:
    """``processing_time`` for live runs, ``available_now`` for backfill and tests."""

    processing_time: str | None = None
    available_now: bool = False

    def kwargs(self) -> dict:
        if self.available_now:
            return {"availableNow": True}
        if self.processing_time:
            return {"processingTime": self.processing_time}
        return {}


@dataclass
class StreamPaths:
    """Checkpoint and output folders of one query."""

    checkpoint: str
    output: str


@dataclass
class StartedQueries:
    """The queries a job started, by name."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def await_all(self) -> None:
        for q in self.queries.values():
            q.awaitTermination()

    def stop_all(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()


# Partitions of the state of queries whose key domain is small and fixed (a few
# payment codes; calendar days). The number is fixed when a query's checkpoint
# is created; zone demand, whose state grows with the data, takes the
# session's spark.sql.shuffle.partitions.
STATE_PARTITIONS = {"daily_stats": 4, "payment_analysis": 1}


def default_state_partitions(spark) -> int:
    """The session's shuffle partitions: a checkpoint keeps the number, however many slots the cluster has at its start."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def start_conf(spark, conf: dict[str, str]):
    """Settings a streaming query takes when it starts (the session's values are restored)."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _state_partitions(spark, n: int | None):
    """Start a query with ``n`` state partitions."""
    return start_conf(spark, {"spark.sql.shuffle.partitions": str(n)} if n else {})


def _start(
    df: DataFrame, name: str, mode: str, sink, paths: StreamPaths, trigger: Trigger,
    state_partitions: int | None = None,
) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", paths.checkpoint)
        .foreachBatch(sink)
    )
    kw = trigger.kwargs()
    if kw:
        writer = writer.trigger(**kw)
    with start_conf(df.sparkSession, WATERMARK_POLICY), _state_partitions(df.sparkSession, state_partitions):
        return writer.start()


def zone_demand_stream(trips: DataFrame, lateness: str | None = ZONE_LATENESS, window: str = ZONE_WINDOW) -> DataFrame:
    """Watermarked hourly zone demand (update mode: changed groups per batch).

    ``lateness=None``: the trips already carry a watermark (one per feed)."""
    cleaned = clean_stream(trips)
    if lateness:
        cleaned = cleaned.withWatermark("pickup_datetime", lateness)
    return running.zone_demand(cleaned, window)


def start_zone_demand(
    trips: DataFrame, paths: StreamPaths, trigger: Trigger, lateness: str | None = ZONE_LATENESS,
    name: str = "zone_demand", state_partitions: int | None = None, mode: str = "update",
    no_data_batches: bool = True,
) -> StreamingQuery:
    """``update``: every changed window, kept current through a keyed sink.
    ``append``: each window once, when the watermark closes it, written by the
    exactly-once Parquet file sink (simplest when only final counts matter).

    ``no_data_batches=False`` (update mode, bounded runs): no extra micro-batch
    only to evict expired windows; it would emit nothing in update mode, and a
    later restart from the checkpoint evicts them with its first batch.
    """
    n = state_partitions or default_state_partitions(trips.sparkSession)
    agg = zone_demand_stream(trips, lateness)
    if mode == "update":
        conf = {} if no_data_batches else {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
        with start_conf(trips.sparkSession, conf):
            return _start(agg, name, "update", KeyedUpdateSink(paths.output, ZONE_KEYS), paths, trigger, n)
    if mode != "append":
        raise ValueError(f"unknown output mode {mode!r}")
    writer = (
        agg.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", paths.output)
        .option("checkpointLocation", paths.checkpoint)
    )
    kw = trigger.kwargs()
    if kw:
        writer = writer.trigger(**kw)
    with start_conf(trips.sparkSession, WATERMARK_POLICY), _state_partitions(trips.sparkSession, n):
        return writer.start()


def start_daily_stats(
    trips: DataFrame, paths: StreamPaths, trigger: Trigger, name: str = "daily_stats",
    state_partitions: int | None = STATE_PARTITIONS["daily_stats"],
) -> StreamingQuery:
    """Complete mode: state holds one row per calendar day seen."""
    agg = running.daily_stats(clean_stream(trips))
    return _start(agg, name, "complete", SnapshotSink(paths.output), paths, trigger, state_partitions)


def start_daily_stats_windowed(
    trips: DataFrame, paths: StreamPaths, trigger: Trigger, lateness: str | None,
    name: str = "daily_stats_windowed",
) -> StreamingQuery:
    """Watermarked variant: days behind the watermark leave the state store.

    ``lateness=None``: the trips already carry a watermark (one per feed)."""
    cleaned = clean_stream(trips)
    if lateness:
        cleaned = cleaned.withWatermark("pickup_datetime", lateness)
    agg = running.daily_stats_windowed(cleaned)
    n = STATE_PARTITIONS["daily_stats"]
    return _start(agg, name, "update", KeyedUpdateSink(paths.output, DAY_KEYS), paths, trigger, n)


def start_payment(
    trips: DataFrame, paths: StreamPaths, trigger: Trigger, name: str = "payment_analysis",
    state_partitions: int | None = STATE_PARTITIONS["payment_analysis"],
) -> StreamingQuery:
    """Complete mode over the few payment codes (NULL kept as a group)."""
    agg = running.payment_analysis(clean_stream(trips))
    return _start(agg, name, "complete", SnapshotSink(paths.output), paths, trigger, state_partitions)


def start_payment_memory(trips: DataFrame, name: str = "payment_analysis", trigger: Trigger | None = None):
    """In-memory table of the payment result, for interactive use and tests."""
    agg = running.payment_analysis(clean_stream(trips))
    writer = agg.writeStream.queryName(name).outputMode("complete").format("memory")
    kw = (trigger or Trigger()).kwargs()
    if kw:
        writer = writer.trigger(**kw)
    with _state_partitions(agg.sparkSession, STATE_PARTITIONS["payment_analysis"]):
        return writer.start()


def start_console(
    agg: DataFrame, name: str, mode: str = "update", trigger: Trigger | None = None, rows: int = 20
) -> StreamingQuery:
    """Print each micro-batch's result to the driver log (debugging only)."""
    writer = (
        agg.writeStream.queryName(name)
        .outputMode(mode)
        .format("console")
        .option("truncate", "false")
        .option("numRows", rows)
    )
    kw = (trigger or Trigger()).kwargs()
    if kw:
        writer = writer.trigger(**kw)
    return writer.start()


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the query's stateful operators dropped as late, over its recent progress."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(v or 0)
    return total


def progress_summary(query: StreamingQuery) -> dict:
    """Throughput, state size and late rows of a query's last micro-batch."""
    p = query.lastProgress
    if not p:
        return {"name": query.name, "batch": None}
    ops = p.get("stateOperators", [])
    return {
        "name": query.name,
        "batch": p.get("batchId"),
        "input_rows": p.get("numInputRows"),
        "input_rows_per_sec": p.get("inputRowsPerSecond"),
        "processed_rows_per_sec": p.get("processedRowsPerSecond"),
        "state_rows": sum(int(o.get("numRowsTotal", 0) or 0) for o in ops),
        "dropped_by_watermark": sum(int(o.get("numRowsDroppedByWatermark", 0) or 0) for o in ops),
        "watermark": (p.get("eventTime") or {}).get("watermark"),
    }

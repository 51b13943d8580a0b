"""The streaming job: three aggregations over one trip stream, results saved per batch.

    python -m ridepulse.streaming.job --input hdfs:///trips/stream --format csv \
        --work hdfs:///trips/stream-work [--available-now]

Each query has its own checkpoint under ``--work`` (default: the session's
``spark.checkpoint.dir``). The job waits for any query to end; on interrupt
or failure every query is stopped. Results are already on storage, written
by every micro-batch, so stopping loses nothing. Damaged lines of CSV files
are left out of all three and kept in ``<work>/rejects/output``.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from ridepulse.operators.normalize import DISPATCH, METERED
from ridepulse.schema import MAX_FILES_PER_TRIGGER, TRIGGERS, ZONE_LATENESS
from ridepulse.session import build_session, new_work_dir, prepare
from ridepulse.streaming import queries as sq
from ridepulse.streaming.progress import ProgressLog, late_rows, read_progress
from ridepulse.streaming.rejects import csv_lines, good_trips, read_rejects, start_rejects
from ridepulse.streaming.runs import ZONE_KEYS
from ridepulse.streaming.sinks import compact_updates
from ridepulse.streaming.sources import canonical_stream, names_source, routed_stream

# State kept off the JVM heap, with changelog checkpointing (small commits).
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start_all(
    spark: SparkSession,
    input_dir: str,
    work_dir: str,
    fmt: str = "parquet",
    available_now: bool = False,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    lateness: str = ZONE_LATENESS,
    max_bytes_per_trigger: int | None = None,
    state_partitions: int | None = None,
    zone_mode: str = "update",
    daily_lateness: str | None = None,
    feeds: list[str] | None = None,
    rejects: bool = False,
) -> sq.StartedQueries:
    """Start the three queries over the trip files in ``input_dir``, each with its own
    source, checkpoint and output under ``work_dir``.

    ``feeds`` names the feeds of files that have a ``source`` column: each gets
    a watermark of its own, so feeds years apart may share a folder. Without
    it, one watermark runs over all trips. ``rejects`` (CSV): a fourth query keeps
    the damaged lines, and the three take the others alone."""
    if rejects and fmt != "csv":
        raise ValueError("only CSV files have damaged lines")
    prepare(spark)
    started = sq.StartedQueries()

    def paths(name: str) -> sq.StreamPaths:
        return sq.StreamPaths(f"{work_dir}/{name}/checkpoint", f"{work_dir}/{name}/output")

    def trig(name: str) -> sq.Trigger:
        return sq.Trigger(available_now=True) if available_now else sq.Trigger(TRIGGERS[name])

    def lines():
        return csv_lines(spark, input_dir, max_files_per_trigger, max_bytes_per_trigger, bool(feeds))

    # Each query reads the source itself (own offsets, own state).
    def files():
        if rejects:
            return good_trips(lines())
        return canonical_stream(spark, input_dir, fmt, max_files_per_trigger, max_bytes_per_trigger, bool(feeds))

    def src():
        return files().drop("source")

    def timed(allowed: str):
        """The trips, and the watermark the query still has to set (None: they carry one per feed)."""
        return (routed_stream(files, feeds, allowed), None) if feeds else (src(), allowed)

    try:
        trips, allowed = timed(lateness)
        started.queries["zone_demand"] = sq.start_zone_demand(
            trips, paths("zone_demand"), trig("zone_demand"), allowed,
            state_partitions=state_partitions, mode=zone_mode,
        )
        if daily_lateness:  # watermarked one-day windows: state of closed days is dropped
            trips, allowed = timed(daily_lateness)
            started.queries["daily_stats"] = sq.start_daily_stats_windowed(
                trips, paths("daily_stats"), trig("daily_stats"), allowed, name="daily_stats"
            )
        else:
            started.queries["daily_stats"] = sq.start_daily_stats(src(), paths("daily_stats"), trig("daily_stats"))
        started.queries["payment_analysis"] = sq.start_payment(
            src(), paths("payment_analysis"), trig("payment_analysis")
        )
        if rejects:
            started.queries["rejects"] = start_rejects(lines(), paths("rejects"), trig("payment_analysis"))
    except Exception:
        started.stop_all()
        raise
    return started


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--work", default=None)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER)
    ap.add_argument("--max-bytes-per-trigger", type=int, default=None,
                    help="bound on input bytes per micro-batch (takes a backlog in steps)")
    ap.add_argument("--lateness", default=ZONE_LATENESS)
    ap.add_argument("--daily-lateness", default=None,
                    help="daily statistics on watermarked one-day windows with this lateness (bounded state)")
    ap.add_argument("--zone-mode", default="update", choices=["update", "append"],
                    help="zone demand: every change (update) or closed windows only (append)")
    ap.add_argument("--compact-every", type=float, default=0.0,
                    help="seconds between compactions of the zone-demand output (0: never)")
    ap.add_argument("--report-every", type=float, default=0.0,
                    help="seconds between progress lines (rows/s, state rows, late rows) per query")
    ap.add_argument("--state-partitions", type=int, default=None,
                    help="partitions of the zone-demand state (fixed when its checkpoint is first created)")
    ap.add_argument("--rocksdb", action="store_true",
                    help="keep streaming state in RocksDB (large key spaces; set before a checkpoint is created)")
    ap.add_argument("--feeds", default=None,
                    help="comma-separated feeds of the input files, each with its own watermark; "
                         "default: both, if the files have a source column, else one watermark")
    ap.add_argument("--no-rejects", action="store_true",
                    help="CSV: read damaged values as NULL instead of keeping their lines apart")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, "ridepulse-stream", extra_conf=ROCKSDB_CONF if args.rocksdb else None)
    work = args.work or new_work_dir(spark, "stream-job")
    if args.feeds:
        feeds = [f for f in args.feeds.split(",") if f]
    else:
        feeds = [METERED, DISPATCH] if names_source(spark, args.input, args.format) else None
    keep_rejects = args.format == "csv" and not args.no_rejects
    progress = ProgressLog(spark, f"{work}/progress").attach()
    # Queries that ended earlier in this session must not end the wait at once;
    # reset before starting, so a query failing right away is still seen.
    spark.streams.resetTerminated()
    started = start_all(
        spark, args.input, work, args.format, args.available_now, args.max_files_per_trigger, args.lateness,
        args.max_bytes_per_trigger, args.state_partitions, args.zone_mode, args.daily_lateness, feeds, keep_rejects,
    )
    try:
        if args.available_now:
            started.await_all()
        elif (args.compact_every > 0 and args.zone_mode == "update") or args.report_every > 0:
            ticks = [t for t in (args.compact_every, args.report_every) if t > 0]
            zone_out = f"{work}/zone_demand/output"
            last = {"compact": time.monotonic(), "report": time.monotonic()}
            while not spark.streams.awaitAnyTermination(min(ticks)):
                now = time.monotonic()
                compact_due = now - last["compact"] >= args.compact_every
                if args.compact_every > 0 and args.zone_mode == "update" and compact_due:
                    compact_updates(spark, zone_out, ZONE_KEYS)
                    last["compact"] = now
                if args.report_every > 0 and now - last["report"] >= args.report_every:
                    for q in started.queries.values():
                        print(json.dumps(sq.progress_summary(q)), flush=True)
                    last["report"] = now
        else:
            spark.streams.awaitAnyTermination()
    finally:
        started.stop_all()
        for q in started.queries.values():
            progress.wait(q)
        progress.detach()
    for row in late_rows(read_progress(spark, f"{work}/progress")).collect():  # a row per query
        print(json.dumps(row.asDict()))
    if keep_rejects:
        print(json.dumps({"query": "rejects", "rejected_lines": read_rejects(spark, f"{work}/rejects/output").count()}))
    print(f"results under {work}")


if __name__ == "__main__":
    main()

"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the given tables.

The tables at ``sf_dir`` are bound to the two raw feeds by
``ridepulse.sources.testdata``; from there each query is the library's own
pipeline (normalise -> union -> clean -> summarise), read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.functions.timekeys import month_key
from ridepulse.operators import audit, clean, normalize, replay, running, summaries
from ridepulse.operators.normalize import DISPATCH, METERED
from ridepulse.plans.stored import StoredSummaries
from ridepulse.session import new_work_dir, prepare
from ridepulse.sources import testdata
from ridepulse.sources.manifest import FileManifest
from ridepulse.sources.trip_table import write_trip_table
from ridepulse.streaming.progress import ProgressLog, late_rows, read_progress
from ridepulse.streaming.queries import StreamPaths, Trigger, dropped_by_watermark, start_payment_memory
from ridepulse.streaming.rejects import csv_lines, good_trips, read_rejects, start_rejects
from ridepulse.streaming.state_audit import SOUND, audit_state
from ridepulse.streaming.runs import replayed_trip_stream, run_to_end, testdata_trip_stream, zone_state_conf

Query = Callable[[SparkSession, str], DataFrame]


# ---- trip tables --------------------------------------------------------------


def trips_metered(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return normalize.normalise_batch(testdata.raw_metered(spark, sf_dir), METERED)


def trips_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return normalize.normalise_batch(testdata.raw_dispatch(spark, sf_dir), DISPATCH)


def trips_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.union_trips([trips_metered(spark, sf_dir), trips_dispatch(spark, sf_dir)])


def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch trips without their two all-NULL columns, combined by name."""
    dispatch = trips_dispatch(spark, sf_dir).drop("passenger_count", "payment_type")
    return normalize.union_trips([trips_metered(spark, sf_dir), dispatch], allow_missing=True)


def trips_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(trips_union(spark, sf_dir))


def trips_stream_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return normalize.trips_stream(testdata.raw_metered(spark, sf_dir), testdata.raw_dispatch(spark, sf_dir))


def trips_stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_stream(trips_stream_norm(spark, sf_dir))


def clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_audit(trips_union(spark, sf_dir))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.load_audit(trips_union(spark, sf_dir))


def load_audit_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load audit of every file, with a checksum of its rows."""
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    feeds = [t.withColumn("file", file) for t in (trips_metered(spark, sf_dir), trips_dispatch(spark, sf_dir))]
    return audit.load_audit(feeds[0].unionByName(feeds[1]), by=["source", "file"], checksum=True)


def _drifted_files(spark: SparkSession, sf_dir: str) -> str:
    """Raw files of both feeds as months deliver them: column types change from folder to folder, and within one."""
    work = new_work_dir(spark, "drifted")
    metered, dispatch = testdata.raw_metered(spark, sf_dir), testdata.raw_dispatch(spark, sf_dir)
    half = F.coalesce(F.col("PULocationID") % 2 == 0, F.lit(False))
    whole = F.col("passenger_count").cast("long")
    metered.where(half).write.parquet(f"{work}/raw/a")
    metered.where(~half).withColumn("passenger_count", whole).write.parquet(f"{work}/raw/b")
    dispatch.where(half).write.parquet(f"{work}/raw/c")
    dispatch.where(~half).withColumn("DOLocationID", F.col("DOLocationID").cast("double")).write.mode("append").parquet(f"{work}/raw/c")
    return work


def trips_drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds from raw files of drifting types, scanned twice by a manifest; the second scan opens no footer."""
    prepare(spark)
    work = _drifted_files(spark, sf_dir)
    manifest = FileManifest(spark, f"{work}/manifest")
    paths = [f"{work}/raw/*/*.parquet"]
    if not manifest.refresh(manifest.listing(paths)):
        raise RuntimeError("the first scan saw no files")
    if manifest.refresh(manifest.listing(paths)):
        raise RuntimeError("the second scan opened footers that the manifest has")
    return manifest.scan(paths).trips


# ---- batch summaries ------------------------------------------------------------


def peak_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.peak_hours(trips_clean(spark, sf_dir))


def daily_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.daily_patterns(trips_clean(spark, sf_dir))


def monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.monthly_trends(trips_clean(spark, sf_dir))


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.monthly_revenue(monthly_trends(spark, sf_dir))


def source_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.source_comparison(trips_clean(spark, sf_dir))


def popular_pickup_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.popular_pickup_zones(trips_union(spark, sf_dir))


def top_pickup_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.top_pickup_zones(popular_pickup_zones(spark, sf_dir), 10)


def fare_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.fare_distribution(trips_union(spark, sf_dir))


def payment_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.payment_types(trips_union(spark, sf_dir))


def payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.payment_labels(payment_types(spark, sf_dir))


def payment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.payment_share(payment_labels(spark, sf_dir))


def _stored(result: str) -> Query:
    """A result from summaries stored per month: the trip table without its last month, then that month added."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        trips = trips_union(spark, sf_dir)
        work = new_work_dir(spark, "stored")
        month = month_key("pickup_datetime")
        last = trips.agg(F.max(month)).first()[0]
        late = month.eqNullSafe(last)
        store = StoredSummaries(spark, f"{work}/summaries")
        for part in (trips.where(~late), trips.where(late)):
            write_trip_table(part, f"{work}/table")
            read = store.update(f"{work}/table").read
        if last is not None and any(not name.endswith(f"={last}") for name in read):
            raise RuntimeError(f"adding {last} read other months: {read}")
        return store.results()[result]

    run.__name__ = f"{result}_stored"
    return run


monthly_trends_stored = _stored("monthly_trends")
load_audit_stored = _stored("load_audit")


# ---- running statistics, as batch ---------------------------------------------------


def zone_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.zone_demand(trips_stream_clean(spark, sf_dir))


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.daily_stats(trips_stream_clean(spark, sf_dir))


def payment_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.payment_analysis(trips_stream_clean(spark, sf_dir))


# ---- replay and streaming --------------------------------------------------------------


def replay_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-normalised trips in event-time order, cut into files of 5,000 rows."""
    return replay.assign_slices(trips_stream_norm(spark, sf_dir))


def replay_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips in a seeded shuffle, cut into files of 5,000 rows."""
    return replay.assign_slices(trips_stream_norm(spark, sf_dir), order=replay.SHUFFLE)


def _stream(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        out, _ = run_to_end(spark, testdata_trip_stream(spark, sf_dir), kind, lateness=None)
        return out

    run.__name__ = f"stream_{kind}"
    return run


stream_zone_demand = _stream("zone_demand")
stream_daily_stats = _stream("daily_stats")
stream_daily_windowed = _stream("daily_stats_windowed")
stream_payment = _stream("payment_analysis")


def _replayed(kind: str, fmt: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        out, query = run_to_end(spark, replayed_trip_stream(spark, sf_dir, fmt=fmt), kind, lateness=None)
        late = dropped_by_watermark(query)
        if late:
            raise RuntimeError(f"{kind}: {late} rows dropped as late")
        return out

    return run


# Four files per feed, one per micro-batch; a row dropped as late fails the query.
stream_zone_demand_batches = _replayed("zone_demand", "parquet")
stream_payment_csv = _replayed("payment_analysis", "csv")


def stream_payment_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment statistics (one row per code) kept as an in-memory table and queried by name."""
    prepare(spark)
    name = f"payment_analysis_{uuid.uuid4().hex[:12]}"
    query = start_payment_memory(testdata_trip_stream(spark, sf_dir), name, Trigger(available_now=True))
    query.awaitTermination()
    return spark.sql(f"SELECT * FROM {name}")


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches, rows and rows dropped as late of the zone-demand stream, from the record of all its batches."""
    prepare(spark)
    work = new_work_dir(spark, "late-rows")
    trips, state = replayed_trip_stream(spark, sf_dir), zone_state_conf(spark, sf_dir)
    log = ProgressLog(spark, f"{work}/progress").attach()
    try:
        _, query = run_to_end(spark, trips, "zone_demand", f"{work}/zones", lateness=None, state_conf=state)
        log.wait(query)
    finally:
        log.detach()
    mine = read_progress(spark, f"{work}/progress").where(F.col("run_id") == str(query.runId))
    return late_rows(mine).withColumn("query", F.lit("zone_demand"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a CSV stream by what is damaged in them, and those that reached the payment statistics
    (no reason). Trips of every 50th zone come a second time without a readable fare, of the next one
    without a readable pickup time and fare."""
    trips = trips_stream_norm(spark, sf_dir)
    work = new_work_dir(spark, "rejects")
    zone = F.col("PULocationID") % 50
    no_fare = trips.where(zone == 0).withColumn("fare_amount", F.lit("n/a"))
    neither = trips.where(zone == 1).withColumns({"pickup_datetime": F.lit("soon"), "fare_amount": F.lit("1,5")})
    for lines in (trips, no_fare, neither):
        lines.write.mode("append").option("header", True).csv(f"{work}/in")
    read = csv_lines(spark, f"{work}/in")
    now = Trigger(available_now=True)
    name = f"rejects-{uuid.uuid4().hex[:12]}"
    rejects = start_rejects(read, StreamPaths(f"{work}/checkpoint", f"{work}/out"), now, name)
    paid, _ = run_to_end(spark, good_trips(read), "payment_analysis", f"{work}/payment")
    rejects.awaitTermination()
    bad = read_rejects(spark, f"{work}/out").groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    good = paid.agg(F.coalesce(F.sum("trip_count"), F.lit(0)).alias("lines"))
    return bad.unionByName(good.withColumn("reason", F.lit(None).cast("string")))


def stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two streams of four batches, and those whose stored state does not fit the saved result."""
    prepare(spark)
    work = new_work_dir(spark, "state-audit")
    trips, found = replayed_trip_stream(spark, sf_dir), []
    zones = {"lateness": None, "state_conf": zone_state_conf(spark, sf_dir)}
    for kind, args in (("zone_demand", zones), ("daily_stats", {})):
        out, _ = run_to_end(spark, trips, kind, f"{work}/{kind}", **args)
        found.append(audit_state(spark, f"{work}/{kind}/checkpoint", out, kind).withColumn("query", F.lit(kind)))
    unfit = F.when(~F.col("finding").isin(*SOUND), F.col("groups")).otherwise(0)
    return found[0].unionByName(found[1]).groupBy("query").agg(F.sum("groups").alias("groups"), F.sum(unfit).alias("unfit"))


QUERIES: dict[str, Query] = {
    "trips_metered": trips_metered,
    "trips_dispatch": trips_dispatch,
    "trips_union": trips_union,
    "union_missing_columns": union_missing_columns,
    "trips_drifted": trips_drifted,
    "trips_clean": trips_clean,
    "trips_stream_norm": trips_stream_norm,
    "trips_stream_clean": trips_stream_clean,
    "clean_audit": clean_audit,
    "load_audit": load_audit,
    "load_audit_by_file": load_audit_by_file,
    "peak_hours": peak_hours,
    "daily_patterns": daily_patterns,
    "monthly_trends": monthly_trends,
    "monthly_revenue": monthly_revenue,
    "source_comparison": source_comparison,
    "popular_pickup_zones": popular_pickup_zones,
    "top_pickup_zones": top_pickup_zones,
    "fare_distribution": fare_distribution,
    "payment_types": payment_types,
    "payment_labels": payment_labels,
    "payment_share": payment_share,
    "monthly_trends_stored": monthly_trends_stored,
    "load_audit_stored": load_audit_stored,
    "zone_demand": zone_demand,
    "daily_stats": daily_stats,
    "payment_analysis": payment_analysis,
    "replay_split": replay_split,
    "replay_shuffled": replay_shuffled,
    "stream_zone_demand": stream_zone_demand,
    "stream_daily_stats": stream_daily_stats,
    "stream_payment": stream_payment,
    "stream_daily_windowed": stream_daily_windowed,
    "stream_zone_demand_batches": stream_zone_demand_batches,
    "stream_payment_csv": stream_payment_csv,
    "stream_payment_memory": stream_payment_memory,
    "stream_late_rows": stream_late_rows,
    "stream_rejects": stream_rejects,
    "stream_state_audit": stream_state_audit,
}

"""Trip table at rest, the batch job, the streaming job, sinks and triggers."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from helpers import as_set
from pyspark.sql import functions as F

from ridepulse.operators import replay, running
from ridepulse.operators.clean import clean_stream
import pytest
from ridepulse.sources import testdata
from ridepulse.plans import batch_job, catalog
from ridepulse.schema import TRIP_COLUMNS
from ridepulse.sources.results import read_result_csv
from ridepulse.sources.trip_table import read_trip_table, write_trip_table
from ridepulse.streaming import job as stream_job
from ridepulse.streaming import queries as sq
from ridepulse.streaming.runs import ZONE_KEYS
from ridepulse.streaming.sinks import read_latest, read_snapshot
from ridepulse.streaming.sources import canonical_stream


def test_trip_table_round_trip_and_pruning(spark, tmp_dir):
    trips = catalog.trips_union(spark, SF_SMALL)
    path = write_trip_table(trips, f"{tmp_dir}/trips", num_partitions=4)
    back = read_trip_table(spark, path)
    assert as_set(back.select(*trips.columns)) == as_set(trips)
    some = read_trip_table(spark, path, sources=["yellow_taxi"], months=("2024-01", "2024-01"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pickup_month" in plan
    want = trips.filter((F.col("source") == "yellow_taxi") & (F.date_format("pickup_datetime", "yyyy-MM") == "2024-01"))
    assert some.count() == want.count() > 0


def test_batch_job_writes_every_result(spark, tmp_dir):
    out = f"{tmp_dir}/results"
    report = batch_job.run(spark, out, sf_dir=SF_SMALL)
    assert set(report["per_result"]) >= {"peak_hours", "fare_distribution", "payment_share"}
    peak = read_result_csv(spark, f"{out}/csv/peak_hours", catalog.peak_hours(spark, SF_SMALL).schema)
    assert as_set(peak) == as_set(catalog.peak_hours(spark, SF_SMALL))
    assert as_set(spark.read.parquet(f"{out}/parquet/peak_hours")) == as_set(catalog.peak_hours(spark, SF_SMALL))


def test_batch_job_on_raw_files(spark, tmp_dir):
    from ridepulse.sources import testdata

    testdata.raw_metered(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw/yellow")
    testdata.raw_dispatch(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw/fhvhv")
    trips = batch_job.load_trips(spark, raw=[f"{tmp_dir}/raw/yellow", f"{tmp_dir}/raw/fhvhv"])
    assert as_set(trips) == as_set(catalog.trips_union(spark, SF_SMALL))


def test_stream_job_and_csv_replay(spark, tmp_dir):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    src = f"{tmp_dir}/csv-in"
    replay.write_replay(trips, src, rows_per_file=2000, fmt="csv")
    assert any(f.endswith(".csv") for f in os.listdir(src))
    work = f"{tmp_dir}/work"
    started = stream_job.start_all(spark, src, work, fmt="csv", available_now=True, max_files_per_trigger=1)
    try:
        started.await_all()
    finally:
        started.stop_all()
    cleaned = clean_stream(trips)
    zones = read_latest(spark, f"{work}/zone_demand/output", ZONE_KEYS)
    assert as_set(zones) == as_set(running.zone_demand(cleaned))
    assert as_set(read_snapshot(spark, f"{work}/daily_stats/output")) == as_set(running.daily_stats(cleaned))
    pay = read_snapshot(spark, f"{work}/payment_analysis/output")
    assert as_set(pay) == as_set(running.payment_analysis(cleaned))


def test_memory_sink_sql_and_processing_time_trigger(spark, tmp_dir):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    src = f"{tmp_dir}/in"
    replay.write_replay(trips, src, rows_per_file=4000)
    q = sq.start_payment_memory(
        canonical_stream(spark, src), "payment_analysis_test", sq.Trigger(processing_time="1 second")
    )
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT * FROM payment_analysis_test")
        assert as_set(got) == as_set(running.payment_analysis(clean_stream(trips)))
    finally:
        q.stop()


def test_canonical_columns_of_stream_layout(spark):
    assert catalog.trips_stream_norm(spark, SF_SMALL).columns == TRIP_COLUMNS


def test_batch_job_from_stored_table_with_pruning(spark, tmp_dir):
    table = f"{tmp_dir}/table"
    batch_job.main(["--sf-dir", SF_SMALL, "--write-table", table, "--master", "local[4]"])
    trips = batch_job.load_trips(spark, table=table, sources=["hvfhv"], months=("1995-01", "1996-12"))
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    want = batch_job.load_trips(spark, sf_dir=SF_SMALL, sources=["hvfhv"], months=("1995-01", "1996-12"))
    assert as_set(trips) == as_set(want) and trips.count() > 0
    out = f"{tmp_dir}/res"
    report = batch_job.run(spark, out, table=table, months=("1995-01", "1996-12"))
    assert "peak_hours" in report["per_result"]


def test_trip_table_month_reload_is_idempotent(spark, tmp_dir):
    trips = catalog.trips_union(spark, SF_SMALL).filter(F.col("source") == "hvfhv")
    m = F.date_format("pickup_datetime", "yyyy-MM")
    jan, feb = trips.filter(m == "1996-01"), trips.filter(m == "1996-02")
    path = f"{tmp_dir}/t"
    write_trip_table(jan, path, num_partitions=2)
    write_trip_table(feb, path, num_partitions=2)
    write_trip_table(jan, path, num_partitions=2)  # reload January
    back = read_trip_table(spark, path)
    assert back.count() == jan.count() + feb.count() > 0
    assert as_set(back.drop("pickup_month")) == as_set(jan.unionByName(feb))


def test_replay_job_cli(spark, tmp_dir):
    from ridepulse.plans import replay_job

    report = replay_job.main(["--sf-dir", SF_SMALL, "--out", f"{tmp_dir}/s", "--rows-per-file", "2500"])
    n = catalog.trips_stream_norm(spark, SF_SMALL).count()
    assert report["files"] == -(-n // 2500)
    back = spark.read.schema(catalog.trips_stream_norm(spark, SF_SMALL).schema).option("header", True).csv(f"{tmp_dir}/s")
    assert back.count() == n


def test_stream_job_live_until_a_query_stops(spark, tmp_dir):
    """Live triggers; stopping one query ends the job, which stops the others (W10)."""
    import threading
    import time as _time

    from ridepulse.operators import running as _running
    from ridepulse.operators.clean import clean_stream as _clean_stream

    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    src = f"{tmp_dir}/in"
    replay.write_replay(trips, src, rows_per_file=3000)
    work = f"{tmp_dir}/work"
    before = {q.id for q in spark.streams.active}
    job = threading.Thread(
        target=stream_job.main, args=(["--input", src, "--work", work, "--report-every", "1"],), daemon=True
    )
    job.start()
    deadline = _time.time() + 120
    mine = []
    while _time.time() < deadline and len(mine) < 3:
        mine = [q for q in spark.streams.active if q.id not in before]
        _time.sleep(0.5)
    assert len(mine) == 3
    for q in mine:
        q.processAllAvailable()
    mine[0].stop()
    job.join(timeout=120)
    assert not job.is_alive()
    assert not [q for q in spark.streams.active if q.id not in before]
    cleaned = _clean_stream(trips)
    assert as_set(read_snapshot(spark, f"{work}/payment_analysis/output")) == as_set(
        _running.payment_analysis(cleaned)
    )
    assert as_set(read_latest(spark, f"{work}/zone_demand/output", ZONE_KEYS)) == as_set(
        _running.zone_demand(cleaned)
    )


def test_stream_job_windowed_daily_stats(spark, tmp_dir):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    src = f"{tmp_dir}/in"
    replay.write_replay(trips, src, rows_per_file=3000)
    work = f"{tmp_dir}/work"
    started = stream_job.start_all(spark, src, work, available_now=True, daily_lateness="1 day")
    try:
        started.await_all()
    finally:
        started.stop_all()
    from ridepulse.operators import running as _running
    from ridepulse.operators.clean import clean_stream as _clean_stream

    got = read_latest(spark, f"{work}/daily_stats/output", ["trip_date"])
    assert as_set(got) == as_set(_running.daily_stats(_clean_stream(trips)))


def test_batch_job_fails_on_files_it_cannot_use(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/raw/odd")
    normal = f"{tmp_dir}/raw/yellow"
    testdata.raw_metered(spark, SF_SMALL).write.parquet(normal)
    paths = [normal, f"{tmp_dir}/raw/odd"]
    with pytest.raises(ValueError, match="odd"):
        batch_job.run(spark, f"{tmp_dir}/out", raw=paths)
    report = batch_job.run(spark, f"{tmp_dir}/out", raw=paths, allow_rejected=True)
    assert report["rejected"] and all("odd" in path for path, _ in report["rejected"])

"""Progress of every batch on record, late rows, and a watermark per feed in the job."""

from __future__ import annotations

import json

import pytest
from conftest import SF_SMALL
from helpers import as_set, trip, trips_df
from pyspark.sql import functions as F

from ridepulse.operators import replay, running
from ridepulse.operators.clean import clean_stream
from ridepulse.operators.normalize import DISPATCH, METERED, drop_incomplete, normalise_stream, union_trips
from ridepulse.plans import catalog, replay_job
from ridepulse.sources import testdata
from ridepulse.streaming import job, runs
from ridepulse.streaming import queries as sq
from ridepulse.streaming.progress import ProgressLog, late_rows, read_progress
from ridepulse.streaming.runs import ZONE_KEYS
from ridepulse.streaming.sinks import read_latest
from ridepulse.streaming.sources import canonical_stream, names_source


def test_over_a_hundred_batches(spark, tmp_dir):
    """Late rows of all batches are on record, those the query itself has forgotten too."""
    import datetime as dt

    start = dt.datetime(2023, 1, 1)
    times = [start + dt.timedelta(hours=h) for h in range(110)]
    times[3] = start - dt.timedelta(days=30)  # late in the fourth batch, out of the query's last hundred reports
    trips = trips_df(spark, [trip(pickup_datetime=t, dropoff_datetime=t + dt.timedelta(minutes=9)) for t in times])
    src = f"{tmp_dir}/in"
    for i, t in enumerate(times):
        # one file per batch, in this order
        trips.where(F.col("pickup_datetime") == F.lit(t)).coalesce(1).write.mode("append").parquet(f"{src}")
    log = ProgressLog(spark, f"{tmp_dir}/progress", flush_every=20).attach()
    paths = sq.StreamPaths(f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    q = sq.start_zone_demand(canonical_stream(spark, src, "parquet", 1), paths, sq.Trigger(available_now=True), name="late", state_partitions=1)
    q.awaitTermination()
    log.wait(q)
    log.detach()
    (row,) = late_rows(read_progress(spark, f"{tmp_dir}/progress").where("query = 'late'")).collect()
    assert (row.batches, row.input_rows, row.dropped_rows) == (110, 110, 1)
    assert sq.dropped_by_watermark(q) == 0  # the query remembers its last hundred batches


def _mixed(spark, tmp_dir, fmt):
    """Files that interleave two feeds years apart, each in its own event-time order."""
    feeds = {METERED: testdata.raw_metered(spark, SF_SMALL), DISPATCH: testdata.raw_dispatch(spark, SF_SMALL)}
    src, staging = f"{tmp_dir}/in", f"{tmp_dir}/staging"
    parts = []
    for feed, raw in feeds.items():
        trips = drop_incomplete(normalise_stream(raw, feed)).withColumn("source", F.lit(feed))
        parts.append(trips)
        n = -(-trips.count() // 4)
        replay.assign_slices(trips, n).write.partitionBy("slice").mode("append").parquet(staging)
    for k in range(4):
        rows = spark.read.parquet(f"{staging}/slice={k}").select(*parts[0].columns).coalesce(1)
        writer = rows.write.mode("append")
        writer.option("header", True).csv(src) if fmt == "csv" else writer.parquet(src)
    return union_trips(parts).drop("source"), src


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_feeds_years_apart_in_one_folder(spark, tmp_dir, capsys, fmt):
    trips, src = _mixed(spark, tmp_dir, fmt)
    assert names_source(spark, src, fmt) and not names_source(spark, f"{tmp_dir}/none", fmt)
    args = ["--input", src, "--format", fmt, "--available-now", "--max-files-per-trigger", "1", "--state-partitions", "2"]
    job.main([*args, "--work", f"{tmp_dir}/w"])
    reports = {r["query"]: r for r in map(json.loads, (x for x in capsys.readouterr().out.splitlines() if x.startswith("{")))}
    assert reports["zone_demand"]["dropped_rows"] == 0 and reports["zone_demand"]["batches"] == 4
    want = as_set(running.zone_demand(clean_stream(trips)))
    assert as_set(read_latest(spark, f"{tmp_dir}/w/zone_demand/output", ZONE_KEYS)) == want
    if fmt == "parquet":
        # one watermark over both feeds loses rows of the older one
        started = job.start_all(spark, src, f"{tmp_dir}/one", fmt, available_now=True, max_files_per_trigger=1, state_partitions=2)
        started.await_all()
        assert sq.dropped_by_watermark(started.queries["zone_demand"]) > 0


def test_a_feed_that_is_not_named_fails(spark, tmp_dir):
    rows = trips_df(spark, [trip()], source="other")
    rows.write.parquet(f"{tmp_dir}/in")
    started = job.start_all(spark, f"{tmp_dir}/in", f"{tmp_dir}/w", available_now=True, feeds=[METERED, DISPATCH])
    try:
        with pytest.raises(Exception, match="does not name: other"):
            started.await_all()
    finally:
        started.stop_all()


def test_replay_job_names_the_feed(spark, tmp_dir):
    replay_job.main(["--sf-dir", SF_SMALL, "--out", f"{tmp_dir}/s", "--format", "parquet", "--rows-per-file", "4000", "--with-source"])
    assert {r.source for r in spark.read.parquet(f"{tmp_dir}/s").select("source").distinct().collect()} == {METERED, DISPATCH}


def test_late_rows_of_state_on_disk(spark, monkeypatch, tmp_dir):
    """Zone state that does not fit the heap goes to disk, as its checkpoint says; the record stays whole."""
    monkeypatch.setattr(runs, "STATE_GROUP_BYTES", 1 << 40)  # no heap holds a single group
    monkeypatch.setattr(catalog, "new_work_dir", lambda _, name: f"{tmp_dir}/{name}")
    (late,) = catalog.stream_late_rows(spark, SF_SMALL).collect()
    rows = catalog.trips_stream_norm(spark, SF_SMALL).count()
    assert (late.batches, late.input_rows, late.dropped_rows) == (4, rows, 0)
    with open(f"{tmp_dir}/late-rows/zones/checkpoint/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()
    last = read_progress(spark, f"{tmp_dir}/late-rows/progress").orderBy(F.desc("batch_id")).first()
    assert last.state_rows > 0

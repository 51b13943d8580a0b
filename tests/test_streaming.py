"""Streaming: late rows (G-LATE), batch == stream over replayed files, restart."""

from __future__ import annotations

import datetime as dt
import os
import time

from conftest import SF_SMALL
from helpers import as_set, trip, trips_df
from pyspark.sql import functions as F

from ridepulse.operators import replay, running
from ridepulse.operators.clean import clean_stream
from ridepulse.plans import catalog
from ridepulse.streaming import queries as sq
from ridepulse.streaming.runs import ZONE_KEYS, run_to_end
from ridepulse.streaming.sinks import read_latest, read_updates
from ridepulse.streaming.sources import canonical_stream


def _write_in_order(spark, frames, out_dir):
    """One append per frame; modification times strictly ascending."""
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(out_dir)
        time.sleep(0.05)
    files = sorted(
        (os.path.join(out_dir, f) for f in os.listdir(out_dir) if f.endswith(".parquet")),
        key=os.path.getmtime,
    )
    return files


def _at(day, h, m):
    return dt.datetime(2023, 1, day, h, m)


def test_late_rows_dropped_one_batch_behind(spark, tmp_dir):
    files = [
        [_at(1, 0, 10), _at(31, 23, 0)],
        [_at(1, 0, 20), _at(15, 5, 0), _at(31, 23, 30)],
        [_at(1, 0, 30), _at(15, 5, 10), _at(31, 23, 40)],
    ]
    frames = [trips_df(spark, [trip(pickup_datetime=t, PULocationID=1) for t in ts]) for ts in files]
    src = f"{tmp_dir}/in"
    _write_in_order(spark, frames, src)
    paths = sq.StreamPaths(f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    trips = canonical_stream(spark, src, "parquet", max_files_per_trigger=1)
    q = sq.start_zone_demand(trips, paths, sq.Trigger(available_now=True))
    q.awaitTermination()
    assert q.exception() is None
    emitted = {}
    for r in read_updates(spark, paths.output).collect():
        emitted.setdefault(r.batch_id, set()).add((r.window_start.strftime("%m-%d %H"), r.trip_count))
    assert emitted[0] == {("01-01 00", 1), ("01-31 23", 1)}
    assert emitted[1] == {("01-01 00", 2), ("01-31 23", 2), ("01-15 05", 1)}
    assert emitted[2] == {("01-31 23", 3)}
    assert all(not v for k, v in emitted.items() if k > 2)
    assert sq.dropped_by_watermark(q) == 2


def test_late_rows_append_mode_emits_closed_windows(spark, tmp_dir):
    files = [
        [_at(1, 0, 10), _at(31, 23, 0)],
        [_at(1, 0, 20), _at(15, 5, 0), _at(31, 23, 30)],
        [_at(1, 0, 30), _at(15, 5, 10), _at(31, 23, 40)],
    ]
    frames = [trips_df(spark, [trip(pickup_datetime=t, PULocationID=1) for t in ts]) for ts in files]
    src = f"{tmp_dir}/in"
    _write_in_order(spark, frames, src)
    paths = sq.StreamPaths(f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
    trips = canonical_stream(spark, src, "parquet", max_files_per_trigger=1)
    q = sq.start_zone_demand(trips, paths, sq.Trigger(available_now=True), mode="append")
    q.awaitTermination()
    assert q.exception() is None
    got = {(r.window_start.strftime("%m-%d %H"), r.trip_count) for r in spark.read.parquet(paths.output).collect()}
    assert got == {("01-01 00", 2), ("01-15 05", 1)}
    assert sq.dropped_by_watermark(q) == 2


def _replayed(spark, tmp_dir, n_files, rows=None):
    trips = rows if rows is not None else catalog.trips_stream_norm(spark, SF_SMALL)
    total = trips.count()
    per_file = -(-total // n_files)
    src = f"{tmp_dir}/replay-{n_files}"
    written = replay.write_replay(trips, src, rows_per_file=per_file)
    assert written == n_files
    return trips, src


def test_zone_demand_stream_equals_batch(spark, tmp_dir):
    for n_files in (1, 3, 10):
        trips, src = _replayed(spark, tmp_dir, n_files)
        stream = canonical_stream(spark, src, "parquet", max_files_per_trigger=1)
        got, q = run_to_end(spark, stream, "zone_demand", f"{tmp_dir}/zone-{n_files}")
        assert sq.dropped_by_watermark(q) == 0
        want = running.zone_demand(clean_stream(trips))
        assert as_set(got) == as_set(want), n_files


def test_daily_and_payment_stream_equal_batch(spark, tmp_dir):
    for n_files in (1, 3, 10):
        trips, src = _replayed(spark, tmp_dir, n_files)
        for kind, fn in (("daily_stats", running.daily_stats), ("payment_analysis", running.payment_analysis)):
            stream = canonical_stream(spark, src, "parquet", max_files_per_trigger=1)
            got, _ = run_to_end(spark, stream, kind, f"{tmp_dir}/{kind}-{n_files}")
            assert as_set(got) == as_set(fn(clean_stream(trips))), (kind, n_files)


def test_restart_from_checkpoint(spark, tmp_dir):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    cut = trips.agg(F.percentile_approx("pickup_datetime", 0.5)).first()[0]
    first, second = trips.filter(F.col("pickup_datetime") < cut), trips.filter(F.col("pickup_datetime") >= cut)
    src = f"{tmp_dir}/in"
    work = f"{tmp_dir}/work"
    replay.write_replay(first, src, rows_per_file=1500)
    run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "zone_demand", work)
    run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "daily_stats", f"{work}-daily")
    replay.write_replay(second, src, rows_per_file=1500)
    got, q = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "zone_demand", work)
    assert sq.dropped_by_watermark(q) == 0
    assert as_set(got) == as_set(running.zone_demand(clean_stream(trips)))
    daily, _ = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "daily_stats", f"{work}-daily")
    assert as_set(daily) == as_set(running.daily_stats(clean_stream(trips)))
    # a third run with no new data changes nothing
    again = read_latest(spark, f"{work}/output", ZONE_KEYS)
    assert as_set(again) == as_set(got)


def test_registered_stream_keys_equal_batch_twins(spark):
    for stream_key, batch_key in (
        ("stream_zone_demand", "zone_demand"),
        ("stream_daily_stats", "daily_stats"),
        ("stream_payment", "payment_analysis"),
    ):
        got = catalog.QUERIES[stream_key](spark, SF_SMALL)
        want = catalog.QUERIES[batch_key](spark, SF_SMALL)
        assert got.columns == want.columns
        assert as_set(got) == as_set(want), stream_key


def test_windowed_daily_stats_equals_batch(spark, tmp_dir):
    trips, src = _replayed(spark, tmp_dir, 3)
    paths = sq.StreamPaths(f"{tmp_dir}/dw/ckpt", f"{tmp_dir}/dw/out")
    q = sq.start_daily_stats_windowed(
        canonical_stream(spark, src, "parquet", 1), paths, sq.Trigger(available_now=True), "1 day"
    )
    q.awaitTermination()
    assert q.exception() is None
    got = read_latest(spark, paths.output, ["trip_date"])
    assert as_set(got) == as_set(running.daily_stats(clean_stream(trips)))


def test_compaction_keeps_the_current_table(spark, tmp_dir):
    from ridepulse.streaming.sinks import compact_updates

    trips, src = _replayed(spark, tmp_dir, 5)
    work = f"{tmp_dir}/compact"
    got, _ = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "zone_demand", work)
    out = f"{work}/output"
    before = as_set(got)
    first = compact_updates(spark, out, ZONE_KEYS)
    assert first is not None and first >= 1
    assert as_set(read_latest(spark, out, ZONE_KEYS)) == before
    last = compact_updates(spark, out, ZONE_KEYS, final=True)
    assert last > first
    assert as_set(read_latest(spark, out, ZONE_KEYS)) == before
    assert as_set(read_latest(spark, out, ZONE_KEYS)) == as_set(running.zone_demand(clean_stream(trips)))


def test_shuffled_replay_loses_late_rows(spark, tmp_dir):
    """A 10-minute watermark over rows shuffled across a month drops rows (the
    reason replays default to event-time order); time-ordered files drop none."""
    from conftest import SF_MID

    from ridepulse.sources import testdata
    from ridepulse.operators.normalize import METERED, normalise_stream

    trips = normalise_stream(testdata.raw_metered(spark, SF_MID), METERED)
    want = running.zone_demand(clean_stream(trips))
    results = {}
    for order in (replay.EVENT_TIME, replay.SHUFFLE):
        src = f"{tmp_dir}/{order}"
        replay.write_replay(trips, src, rows_per_file=2000, order=order)
        got, q = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "zone_demand", f"{tmp_dir}/w-{order}")
        results[order] = (as_set(got) == as_set(want), sq.dropped_by_watermark(q))
    assert results[replay.EVENT_TIME] == (True, 0)
    equal, dropped = results[replay.SHUFFLE]
    assert not equal and dropped > 0


def test_feeds_of_different_years_lose_no_rows_over_many_batches(spark, tmp_dir):
    """One feed is decades newer than the other; each arrives in four time-ordered
    files, one file of each per micro-batch. With a watermark per feed no row is late."""
    from ridepulse.operators.normalize import DISPATCH, METERED, normalise_stream
    from ridepulse.sources import testdata
    from ridepulse.streaming.sources import trips_stream

    feeds = {METERED: testdata.raw_metered(spark, SF_SMALL), DISPATCH: testdata.raw_dispatch(spark, SF_SMALL)}
    streams = []
    for feed, raw in feeds.items():
        trips = normalise_stream(raw, feed).dropna(subset=["pickup_datetime", "fare_amount"])
        src = f"{tmp_dir}/{feed}"
        replay.write_replay(trips, src, rows_per_file=-(-trips.count() // 4))
        streams.append(canonical_stream(spark, src, "parquet", max_files_per_trigger=1))
    got, q = run_to_end(spark, trips_stream(streams, "10 minutes"), "zone_demand", f"{tmp_dir}/w", lateness=None)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 4
    assert sq.dropped_by_watermark(q) == 0
    assert as_set(got) == as_set(catalog.zone_demand(spark, SF_SMALL))


def test_empty_input_gives_empty_result(spark, tmp_dir):
    import os as _os

    src = f"{tmp_dir}/empty"
    _os.makedirs(src)
    got, _ = run_to_end(spark, canonical_stream(spark, src), "payment_analysis", f"{tmp_dir}/w")
    assert got.count() == 0
    assert got.columns == ["payment_type", "trip_count", "avg_fare", "avg_tip", "total_revenue"]


def test_compaction_before_any_output(spark, tmp_dir):
    from ridepulse.streaming.sinks import compact_updates

    assert compact_updates(spark, f"{tmp_dir}/nothing-yet", ZONE_KEYS) is None


def test_byte_admission_limit_splits_backlog(spark, tmp_dir):
    trips, src = _replayed(spark, tmp_dir, 4)
    stream = canonical_stream(spark, src, "parquet", max_bytes_per_trigger=1)
    got, q = run_to_end(spark, stream, "payment_analysis", f"{tmp_dir}/bytes")
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 4
    assert as_set(got) == as_set(running.payment_analysis(clean_stream(trips)))


def test_snapshot_sink_over_batches(spark, tmp_dir):
    trips, src = _replayed(spark, tmp_dir, 5)
    work = f"{tmp_dir}/snap"
    got, q = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "daily_stats", work)
    assert len(q.recentProgress) >= 5
    assert as_set(got) == as_set(running.daily_stats(clean_stream(trips)))


def test_progress_summary(spark, tmp_dir):
    trips, src = _replayed(spark, tmp_dir, 2)
    _, q = run_to_end(spark, canonical_stream(spark, src, "parquet", 1), "zone_demand", f"{tmp_dir}/p")
    s = sq.progress_summary(q)
    assert s["name"].startswith("zone_demand") and s["batch"] is not None
    assert s["dropped_by_watermark"] == 0 and s["state_rows"] >= 0

"""Replay split: every row once, slice sizes, order, seeded shuffle, skew."""

from __future__ import annotations

import datetime as dt
import os

from conftest import SF_SMALL
from helpers import as_set, trip, trips_df
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from ridepulse.operators import replay
from ridepulse.plans import catalog
from ridepulse.schema import DISPATCH, METERED
from ridepulse.streaming import runs
from ridepulse.streaming.queries import dropped_by_watermark


def test_every_row_once_in_time_order(spark):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    sliced = replay.assign_slices(trips, rows_per_file=1000)
    assert as_set(sliced.drop("slice")) == as_set(trips)
    sizes = {r.slice: r["count"] for r in sliced.groupBy("slice").count().collect()}
    n = trips.count()
    assert sorted(sizes) == list(range(-(-n // 1000)))
    assert all(v == 1000 for k, v in sizes.items() if k < max(sizes))
    assert sizes[max(sizes)] == n - 1000 * max(sizes)
    bounds = sorted(
        (r.slice, r.lo, r.hi)
        for r in sliced.groupBy("slice")
        .agg(F.min("pickup_datetime").alias("lo"), F.max("pickup_datetime").alias("hi"))
        .collect()
    )
    for (_, _, hi), (_, lo, _) in zip(bounds, bounds[1:]):
        assert hi <= lo


def test_shuffle_order_does_not_depend_on_partitioning(spark):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    a = replay.assign_slices(trips, 500, order=replay.SHUFFLE)
    b = replay.assign_slices(trips.repartition(7), 500, order=replay.SHUFFLE)
    assert as_set(a) == as_set(b)
    # and it is not the time order
    t = replay.assign_slices(trips, 500)
    assert as_set(a) != as_set(t)


def test_row_numbers_are_dense_under_a_hot_timestamp(spark):
    hot = dt.datetime(2023, 3, 1, 8, 0)
    rows = [trip(pickup_datetime=hot) for _ in range(400)]  # identical copies
    rows += [trip(pickup_datetime=hot + dt.timedelta(minutes=i), PULocationID=i) for i in range(800)]
    df = trips_df(spark, rows).repartition(6)
    numbered = replay.with_row_number(df, replay.replay_order(df), "rn")
    got = sorted(r.rn for r in numbered.select("rn").collect())
    assert got == list(range(1200))


def test_explicit_partition_count(spark):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    a = replay.assign_slices(trips, 700, num_partitions=13)
    b = replay.assign_slices(trips, 700)
    assert as_set(a) == as_set(b)


def test_offsets_join_without_broadcast_beyond_the_limit(spark, monkeypatch):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    want = as_set(replay.assign_slices(trips, 700))
    monkeypatch.setattr(replay, "_BROADCAST_MAX_PARTITIONS", 0)
    assert as_set(replay.assign_slices(trips, 700)) == want


def test_files_in_order_and_jobs_do_not_grow_with_slices(spark, tmp_dir):
    """Modification times ascend with the slices, also over a second write; few or many slices take as many jobs."""
    trips = catalog.trips_stream_norm(spark, SF_SMALL).limit(600)
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n, rows in enumerate((300, 10)):
        spark.sparkContext.setJobGroup(f"replay-{n}", "replay")
        replay.write_replay(trips, f"{tmp_dir}/out{n}", rows_per_file=rows)
        jobs.append(len(tracker.getJobIdsForGroup(f"replay-{n}")))
    assert jobs[0] == jobs[1]
    first = replay.write_replay(trips, f"{tmp_dir}/out1", rows_per_file=100)
    files = [f for f in os.listdir(f"{tmp_dir}/out1") if f.startswith("slice-")]
    assert first == 6 and len(files) == 66
    stamps = sorted((os.stat(f"{tmp_dir}/out1/{f}").st_mtime_ns, f) for f in files)
    assert len({t for t, _ in stamps}) == 66
    number = [int(f.split("-")[1]) for _, f in stamps]
    assert number == [*range(60), *range(6)]
    assert spark.read.parquet(f"{tmp_dir}/out1").count() == 1200
    assert replay.write_replay(trips.limit(0), f"{tmp_dir}/none", rows_per_file=10) == 0


def test_a_replayed_feed_is_written_in_files_that_do_not_grow_with_it(spark, monkeypatch, tmp_dir):
    """Four micro-batches a feed still, of several small files each; nothing late, nothing lost."""
    monkeypatch.setattr(runs, "new_work_dir", lambda *_: f"{tmp_dir}/replay")
    stream = runs.replayed_trip_stream(spark, SF_SMALL, task_rows=400)
    for feed in (METERED, DISPATCH):
        rows = spark.read.parquet(f"{tmp_dir}/replay/{feed}")
        per_file = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
        n = sum(per_file)
        assert max(per_file) <= 400 and len(per_file) == -(-n // max(per_file))
    out, query = runs.run_to_end(spark, stream, "zone_demand", f"{tmp_dir}/w", lateness=None)
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    total = catalog.trips_stream_norm(spark, SF_SMALL).count()
    assert len(sizes) == 4 and sum(sizes) == total and max(sizes) <= total // 4 + 20
    assert dropped_by_watermark(query) == 0
    assert as_set(out) == as_set(catalog.zone_demand(spark, SF_SMALL))


def test_slices_are_dealt_over_the_named_partitions(spark, monkeypatch, tmp_dir):
    """The write takes as many partitions as the sort, however few the session has."""
    dealt, repartition = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: dealt.append(a) or repartition(self, *a))
    trips = catalog.trips_stream_norm(spark, SF_SMALL).limit(600)
    assert replay.write_replay(trips, f"{tmp_dir}/out", rows_per_file=20, num_partitions=30) == 30
    assert dealt == [(30, "slice")]
    assert as_set(spark.read.parquet(f"{tmp_dir}/out")) == as_set(trips)

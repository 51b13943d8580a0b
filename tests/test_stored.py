"""Summaries stored per month: equal to the full scan, old months unread, versions kept; the audit by file in the job."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from helpers import as_set, trip, trips_df
from pyspark.sql import functions as F

from ridepulse.operators import audit
from ridepulse.plans import batch_job, catalog, one_pass
from ridepulse.plans.stored import PART, StoredSummaries
from ridepulse.sources import testdata
from ridepulse.sources.feeds import scan_feeds
from ridepulse.sources.trip_table import MONTH_COL, read_trip_table, write_trip_table
from ridepulse.streaming.commits import NothingCommitted


def check(store, trips, **which):
    want = one_pass.results_from_sets(one_pass.summary_sets(trips).cache())
    got = one_pass.results_from_sets(store.sets(**which).cache())
    assert list(got) == list(want)
    for name in want:
        assert got[name].columns == want[name].columns, name
        assert as_set(got[name]) == as_set(want[name]), name


def months_of(spark, table):
    return [r[0] for r in read_trip_table(spark, table).select(MONTH_COL).distinct().orderBy(MONTH_COL).collect()]


@pytest.fixture()
def table(spark, tmp_dir):
    trips = catalog.trips_union(spark, SF_SMALL)
    hot = trips.where("pickup_datetime IS NOT NULL").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n")
    lost = trips.limit(5).withColumn("pickup_datetime", F.lit(None).cast("timestamp"))  # a folder without a month
    return write_trip_table(trips.unionByName(hot).unionByName(lost), f"{tmp_dir}/table", num_partitions=4)


def test_equal_to_a_full_scan_and_only_changed_months_are_read(spark, table, tmp_dir):
    store = StoredSummaries(spark, f"{tmp_dir}/s")
    with pytest.raises(NothingCommitted):
        store.sets()
    first = store.update(table)
    assert len(first.read) > 3 and first.read == sorted(first.read) and not first.gone
    trips = read_trip_table(spark, table).drop(MONTH_COL)
    check(store, trips)
    assert store.update(table).read == []

    month = next(p for p in first.read if p.startswith("source=yellow_taxi"))[-7:]
    again = read_trip_table(spark, table, ["yellow_taxi"], (month, month)).drop(MONTH_COL)
    write_trip_table(again.unionByName(again), table, num_partitions=2)  # a month loaded anew
    second = store.update(table)
    assert second.read == [f"source=yellow_taxi/{MONTH_COL}={month}"]
    files = store.trips(table, second.read).inputFiles()
    assert files and all(second.read[0] in f for f in files)
    check(store, read_trip_table(spark, table).drop(MONTH_COL))
    some = read_trip_table(spark, table, ["yellow_taxi"], (month, month)).drop(MONTH_COL)
    check(store, some, sources=["yellow_taxi"], months=(month, month))
    assert some.count() > 0
    old = one_pass.results_from_sets(store.sets(version=first.version))["source_comparison"]
    new = one_pass.results_from_sets(store.sets())["source_comparison"]
    assert as_set(old) != as_set(new)  # the older version is still whole


def test_sums_do_not_depend_on_the_parts(spark, tmp_dir):
    """A month that holds most rows, an empty measure, a fee with more than two decimals."""
    rows = [trip(fare_amount=0.1, tip_amount=None, payment_type=None) for _ in range(200)]
    rows += [trip(fare_amount=10.25, PULocationID=None, trip_distance=0.125) for _ in range(3)]
    trips = trips_df(spark, rows, "yellow_taxi").unionByName(trips_df(spark, rows[-3:], "hvfhv"))
    table = write_trip_table(trips, f"{tmp_dir}/t", num_partitions=3)
    store = StoredSummaries(spark, f"{tmp_dir}/s")
    store.update(table)
    check(store, trips)
    check(store, trips.limit(0), months=("1999-01", "1999-12"))


def test_gone_months_and_folding(spark, table, tmp_dir):
    store = StoredSummaries(spark, f"{tmp_dir}/s", fold_after=2, keep=0)
    store.update(table)
    months = [m for m in months_of(spark, table) if m]
    # the same folder of summaries for a table that lacks a month, then for one that lacks two
    for n in (1, 2, 3):
        less = read_trip_table(spark, table).where(~F.coalesce(F.col(MONTH_COL).isin(months[:n]), F.lit(False))).drop(MONTH_COL)
        small = write_trip_table(less, f"{tmp_dir}/less{n}", num_partitions=2)
        done = store.update(small)
        assert done.gone and all(p.endswith(f"={months[n - 1]}") for p in done.gone)
        assert len(store.log.version().live) <= 2
        check(store, read_trip_table(spark, small).drop(MONTH_COL))
    assert store._parts(store.log.version()).keys() == store._fingerprints(small).keys()


def test_an_overtaken_update_starts_anew(spark, table, tmp_dir, monkeypatch):
    store, other = (StoredSummaries(spark, f"{tmp_dir}/s") for _ in range(2))
    plain, calls = store._write, []

    def slow(*args):
        calls.append(1)
        if len(calls) == 1:
            other.update(table)
        return plain(*args)

    monkeypatch.setattr(store, "_write", slow)
    assert store.update(table).read == [] and len(calls) == 1
    assert store.log.version().number == 0 and len(store.log.version().live) == 1
    check(store, read_trip_table(spark, table).drop(MONTH_COL))


def test_files_outside_the_partitions_are_an_error(spark, tmp_dir):
    catalog.trips_union(spark, SF_SMALL).limit(3).write.parquet(f"{tmp_dir}/plain")
    with pytest.raises(ValueError, match="outside"):
        StoredSummaries(spark, f"{tmp_dir}/s").update(f"{tmp_dir}/plain")


def test_job_with_stored_summaries(spark, table, tmp_dir):
    args = {"table": table, "summaries": f"{tmp_dir}/s", "formats": ("parquet",)}
    first = batch_job.run(spark, f"{tmp_dir}/out", **args)
    second = batch_job.run(spark, f"{tmp_dir}/out", **args)
    assert first["parts_read"] and second["parts_read"] == []
    want = catalog.summaries.popular_pickup_zones(read_trip_table(spark, table))
    assert as_set(spark.read.parquet(f"{tmp_dir}/out/parquet/popular_pickup_zones")) == as_set(want)
    with pytest.raises(ValueError, match="trip table"):
        batch_job.run(spark, f"{tmp_dir}/out", sf_dir=SF_SMALL, summaries=f"{tmp_dir}/s")


def test_job_audits_every_file_in_its_one_scan(spark, tmp_dir):
    raw = [f"{tmp_dir}/raw/m", f"{tmp_dir}/raw/d"]
    testdata.raw_metered(spark, SF_SMALL).repartition(3).write.parquet(raw[0])
    testdata.raw_dispatch(spark, SF_SMALL).repartition(2).write.parquet(raw[1])
    scan = scan_feeds(spark, raw, with_file=True).trips.withColumnRenamed("_file", "file")
    want = audit.load_audit(scan, by=["source", "file"], checksum=True)
    batch_job.run(spark, f"{tmp_dir}/out", raw=raw, file_audit=True, formats=("parquet",))
    got = spark.read.parquet(f"{tmp_dir}/out/parquet/load_audit_by_file")
    assert got.count() == 5 and got.columns == want.columns
    assert as_set(got) == as_set(want)
    peak = spark.read.parquet(f"{tmp_dir}/out/parquet/peak_hours")
    assert as_set(peak) == as_set(catalog.peak_hours(spark, SF_SMALL))
    plan = one_pass.summary_sets(scan_feeds(spark, raw, with_file=True).trips, by_file=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and PART not in plan
    with pytest.raises(ValueError, match="raw files"):
        batch_job.run(spark, f"{tmp_dir}/out", sf_dir=SF_SMALL, file_audit=True)

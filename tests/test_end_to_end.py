"""Raw monthly files with drifting types -> scan -> trip table -> batch job."""

from __future__ import annotations

from conftest import SF_MID
from helpers import as_set
from pyspark.sql import functions as F

from ridepulse.plans import batch_job, catalog
from ridepulse.sources import testdata
from ridepulse.sources.feeds import scan_feeds
from ridepulse.sources.results import read_result_csv
from ridepulse.sources.trip_table import write_trip_table


def _write_periods(df, period, out: str, drift_period: str, drift: dict[str, str]) -> None:
    """One file per period; in ``drift_period`` some columns get another physical type."""
    periods = [r[0] for r in df.select(period.alias("p")).distinct().collect()]
    for m in sorted(periods):
        part = df.filter(period == m)
        if m == drift_period:
            part = part.select(*[F.col(c).cast(drift[c]).alias(c) if c in drift else F.col(c) for c in part.columns])
        part.coalesce(1).write.parquet(f"{out}/{m}")


def test_raw_files_to_results(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    metered = testdata.raw_metered(spark, SF_MID)
    dispatch = testdata.raw_dispatch(spark, SF_MID).filter(F.year("pickup_datetime") == 1996)
    week = F.format_string("w%02d", F.weekofyear("tpep_pickup_datetime"))
    _write_periods(metered, week, f"{raw}/yellow", "w02", {"passenger_count": "bigint", "PULocationID": "int"})
    month = F.date_format("pickup_datetime", "yyyy-MM")
    _write_periods(dispatch, month, f"{raw}/fhvhv", "1996-06", {"trip_miles": "float"})

    scan = scan_feeds(spark, [f"{raw}/yellow/*", f"{raw}/fhvhv/*"])
    assert scan.rejected.count() == 0
    assert scan.schemas.count() == 4  # each feed: usual + drifted
    want_trips = catalog.trips_metered(spark, SF_MID).unionByName(
        catalog.trips_dispatch(spark, SF_MID).filter(F.year("pickup_datetime") == 1996)
    )
    assert scan.trips.count() == want_trips.count()

    table = write_trip_table(scan.trips, f"{tmp_dir}/table", num_partitions=4)
    out = f"{tmp_dir}/results"
    batch_job.run(spark, out, table=table, formats=("csv",))
    from ridepulse.operators import clean, summaries

    want_peak = summaries.peak_hours(clean.clean(want_trips))
    got_peak = read_result_csv(spark, f"{out}/csv/peak_hours", want_peak.schema)
    assert as_set(got_peak) == as_set(want_peak)
    want_zones = summaries.popular_pickup_zones(want_trips)
    got_zones = read_result_csv(spark, f"{out}/csv/popular_pickup_zones", want_zones.schema)
    assert as_set(got_zones) == as_set(want_zones)

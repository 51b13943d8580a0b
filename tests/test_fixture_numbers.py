"""Golden numbers of FIXTURES.md §5 on the sf0.01 tables."""

from __future__ import annotations

from conftest import SF_MID
from pyspark.sql import functions as F

from ridepulse.plans import catalog


def test_counts_per_feed_and_cleaning(spark):
    by_src = {r.source: r["count"] for r in catalog.trips_union(spark, SF_MID).groupBy("source").count().collect()}
    assert by_src == {"yellow_taxi": 10000, "hvfhv": 60000}
    cleaned = {r.source: r["count"] for r in catalog.trips_clean(spark, SF_MID).groupBy("source").count().collect()}
    assert cleaned == {"yellow_taxi": 9479, "hvfhv": 24899}
    peak = catalog.peak_hours(spark, SF_MID).collect()
    assert len(peak) == 24 and sum(r.total_trips for r in peak) == 34378


def test_fare_buckets_and_payment_codes(spark):
    buckets = [r["count"] for r in catalog.fare_distribution(spark, SF_MID).collect()]
    assert buckets == [1861, 2052, 1788, 2951, 5243, 56105]
    codes = {
        r.payment_type: r["count"]
        for r in catalog.trips_union(spark, SF_MID).groupBy("payment_type").count().collect()
    }
    assert codes == {0: 2014, 1: 2006, 2: 1981, 3: 2017, 4: 1982, None: 60000}


def test_group_counts(spark):
    assert catalog.daily_patterns(spark, SF_MID).count() == 7
    assert catalog.monthly_trends(spark, SF_MID).count() == 84
    assert catalog.zone_demand(spark, SF_MID).count() == 69264
    assert catalog.daily_stats(spark, SF_MID).count() == 2529
    assert catalog.payment_analysis(spark, SF_MID).count() == 5
    assert catalog.popular_pickup_zones(spark, SF_MID).count() == 150
    assert catalog.trips_stream_norm(spark, SF_MID).count() == 70000


def test_metered_zone_demand_by_hour(spark):
    # FIXTURES: replay of events as zone demand by hour has 9,567 groups
    from ridepulse.operators import running
    from ridepulse.operators.clean import clean_stream
    from ridepulse.operators.normalize import METERED, normalise_stream
    from ridepulse.sources import testdata

    metered = normalise_stream(testdata.raw_metered(spark, SF_MID), METERED)
    assert running.zone_demand(clean_stream(metered)).count() == 9567
    assert metered.filter(F.col("pickup_datetime").isNull()).count() == 0

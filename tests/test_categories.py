"""Buckets, labels, top-k and NULL keys (FIXTURES G-BUCKET, G-LABEL, G-TOPK, G-NULLKEY)."""

from __future__ import annotations

import pytest
from helpers import trip, trips_df
from pyspark.sql import functions as F

from ridepulse.functions.categories import fare_bucket_label, fare_bucket_ord, payment_label
from ridepulse.operators import running, summaries


@pytest.mark.parametrize(
    "fare,label",
    [
        (-1.0, None),
        (0.0, None),
        (5.0, "Under $10"),
        (10.0, "Under $10"),
        (10.01, "$10-$20"),
        (20.0, "$10-$20"),
        (30.0, "$20-$30"),
        (50.0, "$30-$50"),
        (100.0, "$50-$100"),
        (100.01, "$100+"),
        (999999.0, "$100+"),
        (1000000.0, None),
        (None, None),
    ],
)
def test_fare_bucket_edges(spark, fare, label):
    df = spark.createDataFrame([(fare,)], "fare_amount double")
    got = df.select(fare_bucket_label(fare_bucket_ord("fare_amount"))).first()[0]
    assert got == label


def test_fare_distribution_lists_empty_buckets(spark):
    rows = [trip(fare_amount=f) for f in (5.0, 5.0, 15.0, 250.0, -3.0)]
    out = summaries.fare_distribution(trips_df(spark, rows)).collect()
    assert [(r.fare_bucket, r.bucket_ord, r["count"]) for r in out] == [
        ("Under $10", 1, 2),
        ("$10-$20", 2, 1),
        ("$20-$30", 3, 0),
        ("$30-$50", 4, 0),
        ("$50-$100", 5, 0),
        ("$100+", 6, 1),
    ]


@pytest.mark.parametrize(
    "code,label", [(0, "Other"), (1, "Credit Card"), (2, "Cash"), (3, "No Charge"), (4, "Dispute"),
                   (5, "Unknown"), (6, "Other"), (None, "Other")]
)
def test_payment_labels(spark, code, label):
    df = spark.createDataFrame([(code,)], "payment_type int")
    assert df.select(payment_label()).first()[0] == label


def test_top_k_ties_by_zone_id(spark):
    zones = spark.createDataFrame(
        [(3, 5, 1.0), (1, 5, 1.0), (2, 7, 1.0)], "PULocationID int, total_pickups long, avg_fare double"
    )
    got = [r.PULocationID for r in summaries.top_pickup_zones(zones, 2).collect()]
    assert got == [2, 1]


def test_null_payment_key(spark):
    rows = [trip(payment_type=1), trip(payment_type=1), trip(payment_type=None)]
    df = trips_df(spark, rows)
    batch = [(r.payment_type, r.total_trips) for r in summaries.payment_types(df).collect()]
    assert batch == [(1, 2)]
    stream = sorted(
        ((r.payment_type, r.trip_count) for r in running.payment_analysis(df).collect()),
        key=lambda t: (t[0] is not None, t[0] or 0),
    )
    assert stream == [(None, 1), (1, 2)]


def test_payment_share_tenths(spark):
    df = spark.createDataFrame(
        [(1, "Credit Card", 1, 0.0), (2, "Cash", 2, 0.0)],
        "payment_type int, payment_label string, total_trips long, avg_tip double",
    )
    got = {r.payment_type: r.share_pct for r in summaries.payment_share(df).collect()}
    assert got == {1: 33.3, 2: 66.7}


def test_rounding_is_half_up_on_exact_sums(spark):
    # 1.005 is not exact in binary; the decimal path sees exactly 1.005 -> 1.01
    rows = [trip(fare_amount=1.00, total_amount=1.0), trip(fare_amount=1.01, total_amount=1.0)]
    out = running.payment_analysis(trips_df(spark, rows)).first()
    assert out.avg_fare == 1.01


def test_monthly_revenue_picks_candidates(spark):
    monthly = spark.createDataFrame([("2023-01", 3, 10.5)], "month string, total_trips long, total_revenue double")
    out = summaries.monthly_revenue(monthly)
    assert out.columns == ["month", "total_trips", "revenue"]
    with_tips = monthly.withColumn("tips", F.lit(1.0))
    assert summaries.monthly_revenue(with_tips).columns == ["month", "total_trips", "revenue", "tips"]


def test_fallbacks_for_missing_metric_columns(spark):
    df = trips_df(spark, [trip(), trip(PULocationID=3)]).drop("fare_amount", "tip_amount")
    zones = summaries.popular_pickup_zones(df).collect()
    assert {r.avg_fare for r in zones} == {0.0}
    pays = summaries.payment_types(df).collect()
    assert [(r.payment_type, r.total_trips, r.avg_tip) for r in pays] == [(1, 2, None)]


def test_sort_if_present(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "day_of_week int")
    assert [r[0] for r in summaries.sort_if_present(df, "day_of_week").collect()] == [1, 2, 3]
    assert summaries.sort_if_present(df, "missing") is df

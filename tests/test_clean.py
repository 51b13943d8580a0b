"""Golden rows of the batch and stream cleaners (FIXTURES G-CLEAN, G-STREAMCLEAN)."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import BASE_PICKUP, trip, trips_df

from ridepulse.operators.clean import clean, clean_audit, clean_stream

T = BASE_PICKUP


def _kept(spark, rows, fn):
    return fn(trips_df(spark, rows, "yellow_taxi")).count()


@pytest.mark.parametrize(
    "change,kept",
    [
        ({}, 1),
        ({"trip_distance": 0.0}, 0),
        ({"trip_distance": None}, 0),
        ({"fare_amount": 0.0}, 0),
        ({"fare_amount": 500.0}, 0),
        ({"fare_amount": None}, 0),
        ({"fare_amount": 499.99}, 1),
        ({"pickup_datetime": None}, 0),
        ({"dropoff_datetime": None}, 0),
        ({"dropoff_datetime": T + dt.timedelta(minutes=1)}, 0),
        ({"dropoff_datetime": T + dt.timedelta(minutes=1, seconds=1)}, 1),
        ({"dropoff_datetime": T + dt.timedelta(hours=2, minutes=59, seconds=59)}, 1),
        ({"dropoff_datetime": T + dt.timedelta(hours=3)}, 0),
        ({"dropoff_datetime": T - dt.timedelta(minutes=5)}, 0),
    ],
)
def test_batch_cleaner_edges(spark, change, kept):
    assert _kept(spark, [trip(**change)], clean) == kept


def test_duration_column_is_double_minutes(spark):
    out = clean(trips_df(spark, [trip()], "yellow_taxi")).select("trip_duration_min").first()[0]
    assert out == 20.0


def test_fractional_seconds_are_dropped(spark):
    # 60.9 s: whole seconds = 60 -> exactly 1.0 minute -> removed
    row = trip(dropoff_datetime=T + dt.timedelta(seconds=60, microseconds=900000))
    assert _kept(spark, [row], clean) == 0


@pytest.mark.parametrize(
    "change,kept",
    [
        ({"fare_amount": 0.0}, 1),
        ({"fare_amount": -0.01}, 0),
        ({"fare_amount": None}, 0),
        ({"trip_distance": 0.0}, 1),
        ({"trip_distance": None}, 0),
        ({"total_amount": None}, 0),
        ({"dropoff_datetime": None}, 1),
        ({"pickup_datetime": None}, 0),
        ({"fare_amount": 10000.0}, 1),
    ],
)
def test_stream_cleaner_edges(spark, change, kept):
    assert _kept(spark, [trip(**change)], clean_stream) == kept


def test_clean_audit_counts_each_rule(spark):
    rows = [
        trip(),
        trip(trip_distance=0.0),
        trip(trip_distance=0.0, fare_amount=600.0),
        trip(dropoff_datetime=None),
    ]
    a = clean_audit(trips_df(spark, rows, "yellow_taxi")).first().asDict()
    assert a["rows_before"] == 4
    assert a["rows_after"] == 1
    assert a["rows_removed"] == 3
    assert a["fail_distance_positive"] == 2
    assert a["fail_fare_below_max"] == 1
    assert a["fail_dropoff_present"] == 1
    # a NULL dropoff also fails both duration rules (NULL is not kept)
    assert a["fail_duration_above_min"] == 1


def test_clean_audit_on_generated_tables(spark):
    from conftest import SF_MID

    from ridepulse.plans.catalog import clean_audit as q

    got = {r["source"]: r.asDict() for r in q(spark, SF_MID).collect()}
    m, d = got["yellow_taxi"], got["hvfhv"]
    assert (m["rows_before"], d["rows_before"]) == (10000, 60000)
    assert (m["rows_after"], d["rows_after"]) == (9479, 24899)
    assert m["fail_distance_positive"] == 93 and d["fail_distance_positive"] == 0
    assert m["fail_fare_below_max"] == 0 and d["fail_fare_below_max"] == 31770
    assert m["fail_duration_above_min"] == 183 and d["fail_duration_above_min"] == 0
    assert m["fail_duration_below_max"] == 249 and d["fail_duration_below_max"] == 7135

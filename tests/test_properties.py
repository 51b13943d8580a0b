"""Property tests: Spark rules against plain-Python statements of the same rules."""

from __future__ import annotations

import datetime as dt

from helpers import trips_df
from hypothesis import given, settings
from hypothesis import strategies as st

from ridepulse.functions.categories import fare_bucket_ord
from ridepulse.operators.clean import clean, clean_stream
from ridepulse.schema import FARE_BUCKET_EDGES

T0 = dt.datetime(2023, 5, 1, 12, 0, 0)
MONEY = st.one_of(st.none(), st.sampled_from([-0.01, 0.0, 0.01, 10.0, 10.01, 100.0, 499.99, 500.0, 999999.0]),
                  st.integers(-1000, 200000).map(lambda c: c / 100))
SECONDS = st.one_of(st.none(), st.sampled_from([-60, 0, 59, 60, 61, 10799, 10800, 10801]), st.integers(-100, 20000))


def _row(pick_null, secs, dist, fare, total):
    pickup = None if pick_null else T0
    dropoff = None if (secs is None or pickup is None) else T0 + dt.timedelta(seconds=secs)
    return {
        "pickup_datetime": pickup, "dropoff_datetime": dropoff, "passenger_count": 1.0,
        "trip_distance": dist, "PULocationID": 1, "DOLocationID": 2, "payment_type": 1,
        "fare_amount": fare, "tip_amount": 0.0, "total_amount": total,
    }


ROWS = st.lists(
    st.tuples(st.booleans(), SECONDS, st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 0.5, 3.0])), MONEY, MONEY),
    min_size=1, max_size=40,
)


def _batch_ok(r) -> bool:
    if r["pickup_datetime"] is None or r["dropoff_datetime"] is None:
        return False
    if r["trip_distance"] is None or r["fare_amount"] is None:
        return False
    secs = int((r["dropoff_datetime"] - r["pickup_datetime"]).total_seconds())
    return r["trip_distance"] > 0 and 0 < r["fare_amount"] < 500 and 1 < secs / 60 < 180


def _stream_ok(r) -> bool:
    vals = (r["pickup_datetime"], r["fare_amount"], r["trip_distance"], r["total_amount"])
    if any(v is None for v in vals):
        return False
    return r["trip_distance"] >= 0 and r["fare_amount"] >= 0 and r["total_amount"] >= 0


def test_cleaners_match_python(spark):
    @settings(max_examples=12, deadline=None)
    @given(ROWS)
    def check(spec):
        rows = [_row(*s) for s in spec]
        df = trips_df(spark, rows)
        assert clean(df).count() == sum(_batch_ok(r) for r in rows)
        assert clean_stream(df).count() == sum(_stream_ok(r) for r in rows)

    check()


def _bucket(x):
    if x is None or not (FARE_BUCKET_EDGES[0] < x <= FARE_BUCKET_EDGES[-1]):
        return None
    return next(i for i, hi in enumerate(FARE_BUCKET_EDGES[1:], start=1) if x <= hi)


def test_fare_buckets_match_python(spark):
    @settings(max_examples=10, deadline=None)
    @given(st.lists(MONEY, min_size=1, max_size=50))
    def check(fares):
        df = spark.createDataFrame([(i, f) for i, f in enumerate(fares)], "i int, fare_amount double")
        got = {r.i: r.b for r in df.select("i", fare_bucket_ord("fare_amount").alias("b")).collect()}
        assert got == {i: _bucket(f) for i, f in enumerate(fares)}

    check()

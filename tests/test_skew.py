"""A key holding a third of all rows: results stay exact and work stays split."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

from helpers import trip, trips_df

from ridepulse.operators import running, summaries
from ridepulse.sources.trip_table import write_trip_table

HOT = dt.datetime(2023, 3, 1, 8, 0)


def _skewed_rows(n: int = 900) -> list[dict]:
    rows = []
    for i in range(n):
        if i % 3 == 0:  # a third: same zone, same instant, same fare (identical copies)
            rows.append(trip(pickup_datetime=HOT, PULocationID=7, fare_amount=12.5, total_amount=13.5))
        else:
            rows.append(
                trip(
                    pickup_datetime=HOT + dt.timedelta(minutes=7 * i),
                    PULocationID=100 + i % 50,
                    fare_amount=5.0 + (i % 40),
                    total_amount=6.0 + (i % 40),
                )
            )
    return rows


def test_aggregates_exact_under_a_hot_key(spark):
    rows = _skewed_rows()
    df = trips_df(spark, rows, "yellow_taxi").repartition(6)
    zones = {r.PULocationID: (r.total_pickups, r.avg_fare) for r in summaries.popular_pickup_zones(df).collect()}
    want = Counter(r["PULocationID"] for r in rows)
    assert {k: v[0] for k, v in zones.items()} == dict(want)
    assert zones[7] == (300, 12.5)
    top = [r.PULocationID for r in summaries.top_pickup_zones(summaries.popular_pickup_zones(df), 3).collect()]
    assert top[0] == 7
    hot = [r for r in running.zone_demand(df).collect() if r.PULocationID == 7]
    assert sum(r.trip_count for r in hot) == 300
    assert {r.total_revenue for r in hot} == {300 * 13.5}


def test_trip_table_splits_a_hot_month(spark, tmp_dir):
    rows = [dict(r, pickup_datetime=HOT) for r in _skewed_rows(1200)]  # one month, one instant
    df = trips_df(spark, rows, "yellow_taxi")
    path = write_trip_table(df, f"{tmp_dir}/t", num_partitions=4)
    part = f"{path}/source=yellow_taxi/pickup_month=2023-03"
    files = [f for f in os.listdir(part) if f.endswith(".parquet")]
    assert len(files) >= 3
    counts = sorted(spark.read.parquet(f"{part}/{f}").count() for f in files)
    assert sum(counts) == 1200 and counts[-1] <= 2 * counts[0]

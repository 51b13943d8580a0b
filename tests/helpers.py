from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ridepulse.schema import TRIP_COLUMNS, TRIPS

BASE_PICKUP = dt.datetime(2023, 1, 5, 10, 0, 0)


def trip(**kw) -> dict:
    row = {
        "pickup_datetime": BASE_PICKUP,
        "dropoff_datetime": BASE_PICKUP + dt.timedelta(minutes=20),
        "passenger_count": 1.0,
        "trip_distance": 1.0,
        "PULocationID": 1,
        "DOLocationID": 2,
        "payment_type": 1,
        "fare_amount": 10.0,
        "tip_amount": 1.0,
        "total_amount": 11.0,
    }
    row.update(kw)
    return row


def trips_df(spark: SparkSession, rows: list[dict], source: str | None = None) -> DataFrame:
    data = [tuple(r[c] for c in TRIP_COLUMNS) for r in rows]
    df = spark.createDataFrame(data, TRIPS)
    if source is not None:
        from pyspark.sql import functions as F

        df = df.withColumn("source", F.lit(source))
    return df


def as_set(df: DataFrame, cols: list[str] | None = None) -> list[tuple]:
    cols = cols or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)

"""Binding of the driver's generated tables to the two raw trip feeds.

The generated tables hold no trips, so ``events`` plays the metered feed and
``lineitem`` the dispatch feed. Each function returns a DataFrame with the
column names and raw types of one feed's monthly files; everything after this
point (normalising, cleaning, summaries) is the same code real files go
through. Expressions are plain column arithmetic: the scan keeps its pruning
and pushdown, and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One generated table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_seconds(ts, seconds):
    return F.timestamp_add("SECOND", seconds, ts)


def _cents_to_money(cents):
    """A whole number of cents as the nearest DOUBLE (what a DECIMAL(12,2) column reads as)."""
    return cents / 100


def metered_from_events(events: DataFrame) -> DataFrame:
    """Raw metered-feed columns derived from ``events`` rows."""
    pickup = F.col("ts")
    value = F.col("value")
    fare_cents = F.floor(value * 100 + 0.5)
    tip_cents = F.floor(value * 20)
    event = F.col("event_type")
    payment = (
        F.when(event == "click", 1)
        .when(event == "purchase", 2)
        .when(event == "signup", 3)
        .when(event == "view", 4)
        .otherwise(0)
    )
    return events.select(
        pickup.alias("tpep_pickup_datetime"),
        _plus_seconds(pickup, F.floor(value * 60)).alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 6).cast("double").alias("passenger_count"),
        F.get_json_object("props", "$.k").try_cast("double").alias("trip_distance"),
        F.col("user_id").alias("PULocationID"),
        (F.col("event_id") % 150).alias("DOLocationID"),
        payment.alias("payment_type"),
        _cents_to_money(fare_cents).alias("fare_amount"),
        _cents_to_money(tip_cents).alias("tip_amount"),
        _cents_to_money(fare_cents + tip_cents).alias("total_amount"),
    )


def dispatch_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw dispatch-feed columns derived from ``lineitem`` rows."""
    minute_of_day = (F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 1440
    pickup = F.timestamp_add("MINUTE", minute_of_day, F.col("l_shipdate"))
    price = F.col("l_extendedprice")
    return lineitem.select(
        pickup.alias("pickup_datetime"),
        F.timestamp_add("MINUTE", (F.col("l_quantity") * 4).cast("bigint"), pickup).alias("dropoff_datetime"),
        F.col("l_quantity").alias("trip_miles"),
        F.col("l_suppkey").alias("PULocationID"),
        F.col("l_partkey").alias("DOLocationID"),
        _cents_to_money(F.floor(price)).alias("base_passenger_fare"),
        _cents_to_money(F.floor(price * F.col("l_tax"))).alias("tips"),
        _cents_to_money(F.floor(price * (1 - F.col("l_discount")))).alias("driver_pay"),
    )


def raw_metered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metered feed as raw files would give it."""
    return metered_from_events(table(spark, sf_dir, "events"))


def raw_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dispatch feed as raw files would give it."""
    return dispatch_from_lineitem(table(spark, sf_dir, "lineitem"))

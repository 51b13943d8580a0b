"""Running statistics of the stream, written once for batch and stream frames.

Each function takes a (batch or streaming) DataFrame of cleaned stream trips
and returns the aggregate. The streaming queries call the same functions, so
the batch result is the oracle of the stream result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridepulse.functions.money import money_avg_r2, money_sum_r2
from ridepulse.functions.timekeys import calendar_date, date_key
from ridepulse.schema import ZONE_WINDOW


def zone_demand_agg(trips: DataFrame, window: str = ZONE_WINDOW) -> DataFrame:
    """Trips, average fare and revenue per pickup zone and tumbling window."""
    return trips.groupBy(F.window("pickup_datetime", window).alias("window"), "PULocationID").agg(
        F.count(F.lit(1)).alias("trip_count"),
        money_avg_r2("fare_amount").alias("avg_fare"),
        money_sum_r2("total_amount").alias("total_revenue"),
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def zone_demand(trips: DataFrame, window: str = ZONE_WINDOW) -> DataFrame:
    """Zone demand with the window flattened (the registered result layout)."""
    return flatten_window(zone_demand_agg(trips, window))


def _daily_measures() -> list:
    return [
        F.count(F.lit(1)).alias("total_trips"),
        money_avg_r2("fare_amount").alias("avg_fare"),
        money_avg_r2("tip_amount").alias("avg_tip"),
        money_avg_r2("trip_distance").alias("avg_distance"),
        money_sum_r2("total_amount").alias("total_revenue"),
    ]


def daily_stats(trips: DataFrame) -> DataFrame:
    """Running statistics per calendar day (``yyyy-MM-dd`` of the pickup).

    Grouped on the date value; the text key is formatted on the aggregated rows.
    """
    agg = trips.groupBy(calendar_date().alias("_day")).agg(*_daily_measures())
    return agg.select(date_key("_day").alias("trip_date"), *[c for c in agg.columns if c != "_day"])


def daily_stats_windowed(trips: DataFrame) -> DataFrame:
    """Same statistics on a one-day event-time window, for watermarked streams.

    With a watermark, state for days that can no longer change is dropped;
    the plain ``daily_stats`` keeps one state row per day forever.
    """
    out = trips.groupBy(F.window("pickup_datetime", "1 day").alias("window")).agg(*_daily_measures())
    return out.select(
        date_key("window.start").alias("trip_date"),
        *[c for c in out.columns if c != "window"],
    )


def payment_analysis(trips: DataFrame) -> DataFrame:
    """Per payment code, NULL code kept as its own group."""
    return trips.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        money_avg_r2("fare_amount").alias("avg_fare"),
        money_avg_r2("tip_amount").alias("avg_tip"),
        money_sum_r2("total_amount").alias("total_revenue"),
    )

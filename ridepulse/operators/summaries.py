"""Batch summaries of the trip table.

Every summary is a hash aggregate with a partial (map-side) and a final stage,
so a key that holds a third of all rows costs one partial row per map task,
not one task holding a third of the data. Results are small (at most one row
per zone, hour, day or month) and are sorted only after aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.functions.categories import fare_bucket_ord, payment_label
from ridepulse.functions.money import money_avg, money_sum
from ridepulse.functions.timekeys import (
    day_of_week,
    duration_seconds,
    hour_of_day,
    month_key,
    month_start,
    weekday_name,
)
from ridepulse.schema import FARE_BUCKET_LABELS, REVENUE_CANDIDATES, TIPS_CANDIDATES


def sort_small(df: DataFrame, *cols) -> DataFrame:
    """Sort a result whose size is bounded by its key domain (24 hours, 7 days,
    the months of the data) in one partition: the final aggregate stays
    parallel, and no range-partitioning sample job runs for a few rows."""
    return df.repartition(1).sortWithinPartitions(*cols)


def peak_hours(trips: DataFrame) -> DataFrame:
    """Trips, average fare and distance per hour of the day (cleaned rows)."""
    agg = trips.groupBy(hour_of_day().alias("hour")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        money_avg("fare_amount").alias("avg_fare"),
        money_avg("trip_distance").alias("avg_distance"),
    )
    return sort_small(agg, "hour")


def daily_patterns(trips: DataFrame) -> DataFrame:
    """Per weekday. The name depends on the number only, so it is attached to
    the seven aggregated rows instead of being formatted for every trip."""
    agg = trips.groupBy(day_of_week().alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        money_avg("fare_amount").alias("avg_fare"),
        money_avg("tip_amount").alias("avg_tip"),
    )
    out = agg.select(
        "day_of_week", weekday_name("day_of_week").alias("day_name"), "total_trips", "avg_fare", "avg_tip"
    )
    return sort_small(out, "day_of_week")


def monthly_trends(trips: DataFrame) -> DataFrame:
    """Per month; the average duration is whole seconds summed, over 60 * trips."""
    secs = duration_seconds()
    agg = trips.groupBy(month_start().alias("_month")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        money_sum("fare_amount").alias("total_revenue"),
        money_avg("trip_distance").alias("avg_distance"),
        (F.sum(secs).cast("double") / (F.count(secs) * 60)).alias("avg_duration"),
    )
    return sort_small(agg, "_month").select(
        month_key("_month").alias("month"), "total_trips", "total_revenue", "avg_distance", "avg_duration"
    )


def source_comparison(trips: DataFrame) -> DataFrame:
    """Trips, averages and fare revenue per feed (cleaned rows)."""
    return trips.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_trips"),
        money_avg("fare_amount").alias("avg_fare"),
        money_avg("tip_amount").alias("avg_tip"),
        money_avg("trip_distance").alias("avg_distance"),
        money_sum("fare_amount").alias("total_revenue"),
    )


def pick_first_present(df: DataFrame, candidates: list[str]) -> str | None:
    """Name of the first candidate column the frame has."""
    return next((c for c in candidates if c in df.columns), None)


def monthly_revenue(monthly: DataFrame) -> DataFrame:
    """Month, trips, and the revenue / tips series found among the candidates."""
    cols = [F.col("month"), F.col("total_trips")]
    revenue = pick_first_present(monthly, REVENUE_CANDIDATES)
    tips = pick_first_present(monthly, TIPS_CANDIDATES)
    if revenue:
        cols.append(F.col(revenue).cast("double").alias("revenue"))
    if tips:
        cols.append(F.col(tips).cast("double").alias("tips"))
    return monthly.select(*cols).orderBy("month")  # no exchange where ``monthly`` is one partition already


def sort_if_present(df: DataFrame, col: str) -> DataFrame:
    """Order by ``col`` when the frame has it, else leave the order alone."""
    return df.orderBy(col) if col in df.columns else df


def popular_pickup_zones(trips: DataFrame) -> DataFrame:
    """Pickups and average fare per zone; rows without a zone are left out.

    A frame without a fare column gets average fare 0.0 (fixed fallback).
    """
    avg_fare = money_avg("fare_amount") if "fare_amount" in trips.columns else F.lit(0.0)
    return (
        trips.filter(F.col("PULocationID").isNotNull())
        .groupBy("PULocationID")
        .agg(
            F.count(F.lit(1)).alias("total_pickups"),
            avg_fare.alias("avg_fare"),
        )
    )


def top_pickup_zones(zones: DataFrame, k: int = 10) -> DataFrame:
    """The k busiest zones; ties go to the smaller zone id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own k best rows, so only k rows per partition move.
    """
    return (
        zones.orderBy(F.desc("total_pickups"), F.asc("PULocationID"))
        .limit(k)
        .select(
            F.col("PULocationID").cast("string").alias("zone"),
            "PULocationID",
            "total_pickups",
            "avg_fare",
        )
    )


def fare_distribution(trips: DataFrame) -> DataFrame:
    """Rows per fare bucket; all six buckets are listed, empty ones with 0.

    One global aggregate of six conditional counters (one partial row per
    task, one final row), unpacked into the six bucket rows: no join, no
    per-bucket shuffle, and a bucket holding most rows costs nothing extra.
    """
    bucket = fare_bucket_ord("fare_amount")
    n = len(FARE_BUCKET_LABELS)
    counts = trips.agg(*[F.count_if(bucket == i).alias(f"_b{i}") for i in range(1, n + 1)])
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("fare_bucket"),
                F.lit(i).alias("bucket_ord"),
                F.col(f"_b{i}").alias("count"),
            )
            for i, label in enumerate(FARE_BUCKET_LABELS, start=1)
        ]
    )
    return counts.select(F.inline(rows))


def payment_types(trips: DataFrame) -> DataFrame:
    """Trips and average tip per payment code; rows without a code are left out.

    A frame without a tip column gets a NULL average tip.
    """
    avg_tip = money_avg("tip_amount") if "tip_amount" in trips.columns else F.lit(None).cast("double")
    return (
        trips.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            avg_tip.alias("avg_tip"),
        )
    )


def payment_labels(payments: DataFrame) -> DataFrame:
    """Payment results with the label of each code."""
    return payments.select(
        "payment_type", payment_label("payment_type").alias("payment_label"), "total_trips", "avg_tip"
    )


def payment_share(labelled: DataFrame) -> DataFrame:
    """Share of all trips per payment code, in tenths of a percent rounded half up.

    The window spans the whole (tiny, one row per payment code) aggregate.
    """
    total = F.sum("total_trips").over(Window.partitionBy())
    tenths = F.floor((F.col("total_trips") * 2000 + total) / (total * 2))
    return labelled.select(
        "payment_type",
        "payment_label",
        "total_trips",
        (tenths / 10).alias("share_pct"),
    )

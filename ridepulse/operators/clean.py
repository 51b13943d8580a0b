"""Row validity rules of the batch job and of the stream, and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.functions.timekeys import duration_minutes
from ridepulse.schema import MAX_DURATION_MIN, MAX_FARE, MIN_DURATION_MIN


def batch_rules() -> dict[str, Column]:
    """Each named predicate a kept batch row must satisfy (NULL counts as false)."""
    dur = duration_minutes()
    return {
        "distance_positive": F.col("trip_distance") > 0,
        "fare_positive": F.col("fare_amount") > 0,
        "fare_below_max": F.col("fare_amount") < MAX_FARE,
        "pickup_present": F.col("pickup_datetime").isNotNull(),
        "dropoff_present": F.col("dropoff_datetime").isNotNull(),
        "duration_above_min": dur > MIN_DURATION_MIN,
        "duration_below_max": dur < MAX_DURATION_MIN,
    }


def stream_rules() -> dict[str, Column]:
    """Each named predicate a kept stream row must satisfy (zero allowed, no upper limits)."""
    return {
        "pickup_present": F.col("pickup_datetime").isNotNull(),
        "fare_present": F.col("fare_amount").isNotNull(),
        "distance_nonnegative": F.col("trip_distance") >= 0,
        "fare_nonnegative": F.col("fare_amount") >= 0,
        "total_nonnegative": F.col("total_amount") >= 0,
    }


def _all(preds: list[Column]) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def clean(df: DataFrame) -> DataFrame:
    """Batch cleaner: validity filter, trip duration in minutes, duration range.

    Catalyst pushes the column predicates into each scan of the union (they
    show as ``PushedFilters`` where the format allows); the duration bounds
    are evaluated in the same stage, right after the scan.
    """
    rules = batch_rules()
    dur_rules = ["duration_above_min", "duration_below_max"]
    first = _all([v for k, v in rules.items() if k not in dur_rules])
    return (
        df.filter(first)
        .withColumn("trip_duration_min", duration_minutes())
        .filter(
            (F.col("trip_duration_min") > MIN_DURATION_MIN)
            & (F.col("trip_duration_min") < MAX_DURATION_MIN)
        )
    )


def clean_stream(df: DataFrame) -> DataFrame:
    """Stream cleaner: stateless, so the same function serves batch and stream."""
    return df.filter(_all(list(stream_rules().values())))


def clean_audit(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows before / after cleaning and failures per rule, in one pass.

    Each rule is counted over all rows on its own, so one row can fail several.
    """
    rules = batch_rules()
    ok = _all([F.coalesce(p, F.lit(False)) for p in rules.values()])
    aggs = [
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(ok).alias("rows_after"),
        F.count_if(~ok).alias("rows_removed"),
    ]
    aggs += [F.count_if(~F.coalesce(p, F.lit(False))).alias(f"fail_{k}") for k, p in rules.items()]
    return df.groupBy(by).agg(*aggs)

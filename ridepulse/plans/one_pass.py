"""All batch results from ONE scan of the trip table.

The batch job needs thirteen results: four over cleaned rows (hour, weekday,
month, source), five over all rows (zones, fare buckets, payment codes, the
two audits) and four derived from those. Run one by one they scan the feeds
about eight times or cache the cleaned rows; here a single ``groupingSets``
aggregate computes the sums and counts of all of them:

* every row gets its keys and a validity flag (the batch cleaning rules);
* three grouping sets: a fine one, (month, weekday, hour, source, fare
  bucket), whose few hundred thousand groups at most roll up into the hour,
  weekday, month, source and bucket results afterwards, and one per pickup
  zone and per payment code. ``Expand`` emits each row three times inside the
  map task and the partial aggregate collapses the copies at once, so what
  is shuffled is a few rows per task and key, whatever the data size or key
  skew;
* cleaned-row measures are conditional on the flag, all-row measures are not.

The results are read off (and rolled up from) this aggregate, which is small
enough to keep in memory. All its columns add up (or are least and greatest
values), so aggregates of parts of the trips merge into that of all
(``merge``; ``ridepulse.plans.stored`` keeps one per month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.functions.categories import fare_bucket_ord
from ridepulse.functions.money import cents, join_parts, rest
from ridepulse.functions.rowtext import row_md5
from ridepulse.functions.timekeys import (
    day_of_week,
    duration_seconds,
    hour_of_day,
    month_key,
    month_start,
    weekday_name,
)
from ridepulse.operators.audit import checksum_sum
from ridepulse.operators.clean import batch_rules
from ridepulse.operators.summaries import (
    monthly_revenue,
    payment_labels,
    payment_share,
    sort_small,
    top_pickup_zones,
)
from ridepulse.schema import FARE_BUCKET_LABELS, MONEY_COLUMNS, TRIP_COLUMNS
from ridepulse.sources.feeds import FILE_COL

# Grouping columns, in the order given to groupingSets, and the sets; ``file`` only where it is asked for.
FINE = ["_month", "_dow", "_hour", "source", "_bucket"]
KEYS = FINE + ["PULocationID", "payment_type", FILE_COL]
# Summed measures and their columns.
MEASURES = {"_fare": "fare_amount", "_tip": "tip_amount", "_total": "total_amount", "_dist": "trip_distance"}
SETS = {"fine": FINE, "zone": ["PULocationID"], "payment": ["payment_type"], "file": ["source", FILE_COL]}
_CHECKSUM = "_checksum"


def _gid(set_name: str) -> int:
    """Spark's grouping_id: bit (len-1-i) is 1 when KEYS[i] is not grouped."""
    grouped = set(SETS[set_name])
    return sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in grouped)


def summary_sets(trips: DataFrame, by: list[str] | None = None, by_file: bool = False) -> DataFrame:
    """The grouping-sets aggregate of all batch measures (one scan of ``trips``).

    ``by``: columns of ``trips`` that split every set. ``by_file`` adds a set
    per feed and file (trips scanned ``with_file``), with a checksum of the rows.
    """
    by = list(by or [])
    names = [name for name in SETS if by_file or name != "file"]
    rules = batch_rules()
    ok = [F.coalesce(p, F.lit(False)) for p in rules.values()]
    valid = ok[0]
    for p in ok[1:]:
        valid = valid & p
    secs = duration_seconds()

    def when_valid(c: Column) -> Column:
        return F.when(F.col("_valid"), c)

    keyed = trips.select(
        *by,
        F.col(FILE_COL) if by_file else F.lit(None).cast("string").alias(FILE_COL),
        *([row_md5(trips, TRIP_COLUMNS).alias("_md5")] if by_file else []),
        hour_of_day().alias("_hour"),
        day_of_week().alias("_dow"),
        month_start().alias("_month"),
        "source",
        "PULocationID",
        "payment_type",
        valid.alias("_valid"),
        *[(~p).alias(f"_fail_{k}") for k, p in zip(rules, ok)],
        *[F.col(c).isNotNull().alias(f"_nn_{c}") for c in TRIP_COLUMNS],
        F.col("pickup_datetime").alias("_pickup"),
        fare_bucket_ord("fare_amount").alias("_bucket"),
        *[cents(c).alias(m) for m, c in MEASURES.items()],
        *[rest(c).alias(f"{m}_rest") for m, c in MEASURES.items()],
        secs.alias("_secs"),
    )
    v = F.col("_valid")
    aggs = [
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(v).alias("_n"),
        F.sum(when_valid(F.col("_secs"))).alias("_secs_sum"),
        F.count(when_valid(F.col("_secs"))).alias("_secs_n"),
        F.min("_pickup").alias("_min_pickup"),
        F.max("_pickup").alias("_max_pickup"),
    ]
    for m in MEASURES:  # cleaned rows, then (prefix _r) all rows
        for prefix, c, r in (
            (m, when_valid(F.col(m)), when_valid(F.col(f"{m}_rest"))),
            (f"_r{m[1:]}", F.col(m), F.col(f"{m}_rest")),
        ):
            aggs += [F.sum(c).alias(f"{prefix}_sum"), F.sum(r).alias(f"{prefix}_rest"), F.count(c).alias(f"{prefix}_n")]
    aggs += [F.count_if(F.col(f"_fail_{k}")).alias(f"_fail_{k}") for k in rules]
    aggs += [F.count_if(F.col(f"_nn_{c}")).alias(f"_nn_{c}") for c in TRIP_COLUMNS]
    if by_file:
        aggs.append(checksum_sum(F.col("_md5")).alias(_CHECKSUM))
    return keyed.groupingSets([[*by, *SETS[name]] for name in names], *by, *KEYS).agg(*aggs)


def _totals(rows: DataFrame) -> list[Column]:
    """Measures of several groups as those of one."""
    least, greatest = "_min_pickup", "_max_pickup"
    additive = [c for c in rows.columns if c.startswith("_") and c not in (*KEYS, "_gid", least, greatest)]
    return [*(F.sum(c).alias(c) for c in additive), F.min(least).alias(least), F.max(greatest).alias(greatest)]


def merge(sets: DataFrame, drop: list[str]) -> DataFrame:
    """Aggregates of parts of the trips (``summary_sets`` by the columns ``drop``) as the one of all."""
    parts = sets.drop(*drop)
    return parts.groupBy("_gid", *KEYS).agg(*_totals(parts))


_RAW_MONEY = {"fare_amount": "_rfare", "tip_amount": "_rtip", "total_amount": "_rtotal"}


def _rows(sets: DataFrame, name: str) -> DataFrame:
    return sets.filter(F.col("_gid") == _gid(name))


def _sum(measure: str) -> Column:
    return join_parts(F.col(f"{measure}_sum"), F.col(f"{measure}_rest"))


def _avg(measure: str) -> Column:
    return _sum(measure) / F.nullif(F.col(f"{measure}_n"), F.lit(0))


def _rollup(fine: DataFrame, key: str) -> DataFrame:
    """Re-aggregate the fine groups by one of their keys (a small aggregate)."""
    return fine.groupBy(key).agg(*_totals(fine))


def results_from_sets(sets: DataFrame) -> dict[str, DataFrame]:
    """Every batch result, read off the grouping-sets aggregate (cache it first)."""
    fine = _rows(sets, "fine")
    dist = _avg("_dist")
    out: dict[str, DataFrame] = {}
    peak = _rollup(fine, "_hour").filter(F.col("_n") > 0).select(
        F.col("_hour").alias("hour"),
        F.col("_n").alias("total_trips"),
        _avg("_fare").alias("avg_fare"),
        dist.alias("avg_distance"),
    )
    out["peak_hours"] = sort_small(peak, "hour")
    daily = _rollup(fine, "_dow").filter(F.col("_n") > 0).select(
        F.col("_dow").alias("day_of_week"),
        weekday_name("_dow").alias("day_name"),
        F.col("_n").alias("total_trips"),
        _avg("_fare").alias("avg_fare"),
        _avg("_tip").alias("avg_tip"),
    )
    out["daily_patterns"] = sort_small(daily, "day_of_week")
    monthly = sort_small(_rollup(fine, "_month").filter(F.col("_n") > 0), "_month").select(
        month_key("_month").alias("month"),
        F.col("_n").alias("total_trips"),
        _sum("_fare").alias("total_revenue"),
        dist.alias("avg_distance"),
        (F.col("_secs_sum").cast("double") / (F.col("_secs_n") * 60)).alias("avg_duration"),
    )
    out["monthly_trends"] = monthly
    out["monthly_revenue"] = monthly_revenue(monthly)
    src = _rollup(fine, "source")
    out["source_comparison"] = src.filter(F.col("_n") > 0).select(
        "source",
        F.col("_n").alias("total_trips"),
        _avg("_fare").alias("avg_fare"),
        _avg("_tip").alias("avg_tip"),
        dist.alias("avg_distance"),
        _sum("_fare").alias("total_revenue"),
    )
    rules = list(batch_rules())
    out["clean_audit"] = src.select(
        "source",
        F.col("_rows").alias("rows_before"),
        F.col("_n").alias("rows_after"),
        (F.col("_rows") - F.col("_n")).alias("rows_removed"),
        *[F.col(f"_fail_{k}").alias(f"fail_{k}") for k in rules],
    )
    audit = [
        F.col("_rows").alias("rows"),
        *[F.col(f"_nn_{c}").alias(f"nonnull_{c}") for c in TRIP_COLUMNS],
        F.col("_min_pickup").alias("min_pickup"),
        F.col("_max_pickup").alias("max_pickup"),
        _sum("_rdist").alias("sum_distance"),
        *[_sum(_RAW_MONEY[c]).alias(f"sum_{c}") for c in MONEY_COLUMNS],
    ]
    out["load_audit"] = src.select("source", *audit)
    if _CHECKSUM in sets.columns:
        out["load_audit_by_file"] = _rows(sets, "file").select(
            "source", F.col(FILE_COL).alias("file"), *audit, F.col(_CHECKSUM).cast("string").alias("checksum")
        )
    zones = _rows(sets, "zone").filter(F.col("PULocationID").isNotNull()).select(
        "PULocationID",
        F.col("_rows").alias("total_pickups"),
        _avg("_rfare").alias("avg_fare"),
    )
    out["popular_pickup_zones"] = zones
    out["top_pickup_zones"] = top_pickup_zones(zones)
    n_buckets = len(FARE_BUCKET_LABELS)
    counters = fine.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_bucket") == i, F.col("_rows"))), F.lit(0)).alias(f"_b{i}")
            for i in range(1, n_buckets + 1)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(lbl).alias("fare_bucket"), F.lit(i).alias("bucket_ord"), F.col(f"_b{i}").alias("count"))
            for i, lbl in enumerate(FARE_BUCKET_LABELS, start=1)
        ]
    )
    out["fare_distribution"] = counters.select(F.inline(rows))
    payments = _rows(sets, "payment").filter(F.col("payment_type").isNotNull()).select(
        "payment_type",
        F.col("_rows").alias("total_trips"),
        _avg("_rtip").alias("avg_tip"),
    )
    labelled = payment_labels(payments)
    out["payment_types"] = payments
    out["payment_labels"] = labelled
    out["payment_share"] = payment_share(labelled)
    return out

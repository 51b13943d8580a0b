"""Independent SQL (DuckDB dialect) for each registered query.

Written from the definitions, not generated from the Spark plans. Money and
distances are summed as whole millionths; averages rounded to cents use integer
half-up arithmetic on that sum.
"""

from __future__ import annotations

DEC = "DECIMAL(12,2)"


def _micro_sum(col: str) -> str:
    return f"sum(CAST(round({col} * 1000000) AS HUGEINT))"


def _cents_avg_r2(col: str) -> str:
    n = f"(10000 * count({col}))"
    return f"CAST((2 * {_micro_sum(col)} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _money_sum(col: str) -> str:
    return f"CAST({_micro_sum(col)} AS DOUBLE) / 1000000"


def _money_avg(col: str) -> str:
    return f"{_money_sum(col)} / count({col})"


_SECS = "(epoch_us(dropoff_datetime) // 1000000 - epoch_us(pickup_datetime) // 1000000)"

_RAW = f"""
metered_raw AS (
  SELECT ts AS tpep_pickup_datetime,
         ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS tpep_dropoff_datetime,
         CAST(user_id % 6 AS DOUBLE) AS passenger_count,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_distance,
         user_id AS PULocationID,
         event_id % 150 AS DOLocationID,
         CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2
                         WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END AS payment_type,
         CAST(value AS {DEC}) AS fare_amount,
         CAST(floor(value * 20) / 100 AS {DEC}) AS tip_amount,
         CAST(CAST(value AS {DEC}) + CAST(floor(value * 20) / 100 AS {DEC}) AS {DEC}) AS total_amount
  FROM events
),
dispatch_pick AS (
  SELECT *, l_shipdate + to_seconds(CAST(((l_orderkey * 7919 + l_linenumber) % 1440) * 60 AS BIGINT))
            AS pickup_datetime
  FROM lineitem
),
dispatch_raw AS (
  SELECT pickup_datetime,
         pickup_datetime + to_seconds(CAST(l_quantity * 240 AS BIGINT)) AS dropoff_datetime,
         l_quantity AS trip_miles,
         l_suppkey AS PULocationID,
         l_partkey AS DOLocationID,
         CAST(floor(l_extendedprice) / 100 AS {DEC}) AS base_passenger_fare,
         CAST(floor(l_extendedprice * l_tax) / 100 AS {DEC}) AS tips,
         CAST(floor(l_extendedprice * (1 - l_discount)) / 100 AS {DEC}) AS driver_pay
  FROM dispatch_pick
)"""

_METERED_CANON = """
  SELECT CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
         CAST(passenger_count AS DOUBLE) AS passenger_count,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(PULocationID AS INTEGER) AS PULocationID,
         CAST(DOLocationID AS INTEGER) AS DOLocationID,
         CAST(payment_type AS INTEGER) AS payment_type,
         CAST(fare_amount AS DOUBLE) AS fare_amount,
         CAST(tip_amount AS DOUBLE) AS tip_amount,
         CAST(total_amount AS DOUBLE) AS total_amount"""

_TRIPS = f"""{_RAW},
trips_metered AS ({_METERED_CANON}, 'yellow_taxi' AS source
  FROM metered_raw
),
trips_dispatch AS (
  SELECT CAST(pickup_datetime AS TIMESTAMP) AS pickup_datetime,
         CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
         CAST(NULL AS DOUBLE) AS passenger_count,
         CAST(trip_miles AS DOUBLE) AS trip_distance,
         CAST(PULocationID AS INTEGER) AS PULocationID,
         CAST(DOLocationID AS INTEGER) AS DOLocationID,
         CAST(NULL AS INTEGER) AS payment_type,
         CAST(base_passenger_fare AS DOUBLE) AS fare_amount,
         CAST(tips AS DOUBLE) AS tip_amount,
         CAST(driver_pay AS DOUBLE) AS total_amount,
         'hvfhv' AS source
  FROM dispatch_raw
),
trips_union AS (
  SELECT * FROM trips_metered UNION ALL SELECT * FROM trips_dispatch
),
trips_clean AS (
  SELECT * FROM (
    SELECT *, {_SECS} / 60 AS trip_duration_min
    FROM trips_union
    WHERE trip_distance > 0 AND fare_amount > 0 AND fare_amount < 500
      AND pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL
  ) WHERE trip_duration_min > 1 AND trip_duration_min < 180
),
trips_stream_norm AS (
  SELECT * FROM (
    {_METERED_CANON} FROM metered_raw
    UNION ALL
    SELECT CAST(pickup_datetime AS TIMESTAMP), CAST(dropoff_datetime AS TIMESTAMP),
           CAST(1 AS DOUBLE), CAST(trip_miles AS DOUBLE),
           CAST(PULocationID AS INTEGER), CAST(DOLocationID AS INTEGER), CAST(1 AS INTEGER),
           CAST(base_passenger_fare AS DOUBLE), CAST(tips AS DOUBLE),
           CAST(base_passenger_fare AS DOUBLE) + CAST(tips AS DOUBLE)
    FROM dispatch_raw
  ) WHERE pickup_datetime IS NOT NULL AND fare_amount IS NOT NULL
),
trips_stream_clean AS (
  SELECT * FROM trips_stream_norm
  WHERE pickup_datetime IS NOT NULL AND fare_amount IS NOT NULL AND trip_distance >= 0
    AND fare_amount >= 0 AND total_amount >= 0
),
popular_pickup_zones AS (
  SELECT PULocationID, count(*) AS total_pickups, {_money_avg('fare_amount')} AS avg_fare
  FROM trips_union WHERE PULocationID IS NOT NULL GROUP BY PULocationID
),
payment_types AS (
  SELECT payment_type, count(*) AS total_trips, {_money_avg('tip_amount')} AS avg_tip
  FROM trips_union WHERE payment_type IS NOT NULL GROUP BY payment_type
),
payment_labels AS (
  SELECT payment_type,
         CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
                           WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' ELSE 'Other' END AS payment_label,
         total_trips, avg_tip
  FROM payment_types
),
monthly_trends AS (
  SELECT strftime(pickup_datetime, '%Y-%m') AS month,
         count(*) AS total_trips,
         {_money_sum('fare_amount')} AS total_revenue,
         {_money_avg('trip_distance')} AS avg_distance,
         CAST(sum({_SECS}) AS DOUBLE) / (count({_SECS}) * 60) AS avg_duration
  FROM trips_clean GROUP BY 1
)"""


def _with(body: str) -> str:
    return f"WITH {_TRIPS.strip()}\n{body.strip()}\n"


def _fail(pred: str) -> str:
    return f"count_if(NOT coalesce({pred}, false))"


_BATCH_RULES = {
    "distance_positive": "trip_distance > 0",
    "fare_positive": "fare_amount > 0",
    "fare_below_max": "fare_amount < 500",
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "duration_above_min": f"{_SECS} / 60 > 1",
    "duration_below_max": f"{_SECS} / 60 < 180",
}
_ALL_OK = " AND ".join(f"coalesce({p}, false)" for p in _BATCH_RULES.values())

_TRIP_COLS = [
    "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "PULocationID",
    "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount",
]



def _row_md5(prefix: str = "") -> str:
    """MD5 of a trip's values as text: epoch microseconds, six decimals, ~ for NULL."""
    texts = []
    for c in _TRIP_COLS:
        if c.endswith("_datetime"):
            v = f"epoch_us({c})"
        elif c in ("PULocationID", "DOLocationID", "payment_type"):
            v = c
        else:
            v = f"CAST({c} AS DECIMAL(38,6))"
        texts.append(f"'|' || coalesce(CAST({v} AS VARCHAR), '~')")
    return f"md5('{prefix}' || {' || '.join(texts)})"


_AUDIT = (
    "count(*) AS rows, "
    + ", ".join(f"count({c}) AS nonnull_{c}" for c in _TRIP_COLS)
    + ", min(pickup_datetime) AS min_pickup, max(pickup_datetime) AS max_pickup, "
    + f"{_money_sum('trip_distance')} AS sum_distance, "
    + ", ".join(f"{_money_sum(c)} AS sum_{c}" for c in ("fare_amount", "tip_amount", "total_amount"))
)

_REPLAY_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in _TRIP_COLS)

ORACLE_SQL: dict[str, str] = {
    "trips_metered": _with("SELECT * FROM trips_metered"),
    "trips_dispatch": _with("SELECT * FROM trips_dispatch"),
    "trips_union": _with("SELECT * FROM trips_union"),
    "union_missing_columns": _with("SELECT * FROM trips_union"),
    "trips_clean": _with("SELECT * FROM trips_clean"),
    "trips_stream_norm": _with("SELECT * FROM trips_stream_norm"),
    "trips_stream_clean": _with("SELECT * FROM trips_stream_clean"),
    "clean_audit": _with(
        "SELECT source, count(*) AS rows_before,"
        f" count_if({_ALL_OK}) AS rows_after, count_if(NOT ({_ALL_OK})) AS rows_removed, "
        + ", ".join(f"{_fail(p)} AS fail_{k}" for k, p in _BATCH_RULES.items())
        + " FROM trips_union GROUP BY source"
    ),
    "load_audit": _with(f"SELECT source, {_AUDIT} FROM trips_union GROUP BY source"),
    # each generated table is one file
    "load_audit_by_file": _with(
        f"""SELECT source, CASE source WHEN 'yellow_taxi' THEN 'events.parquet' ELSE 'lineitem.parquet' END AS file,
                   {_AUDIT}, CAST(sum(CAST('0x' || substr({_row_md5()}, 1, 8) AS BIGINT)) AS VARCHAR) AS checksum
            FROM trips_union GROUP BY source"""
    ),
    "peak_hours": _with(
        f"""SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS total_trips,
                   {_money_avg('fare_amount')} AS avg_fare, {_money_avg('trip_distance')} AS avg_distance
            FROM trips_clean GROUP BY 1 ORDER BY 1"""
    ),
    "daily_patterns": _with(
        f"""SELECT CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week,
                   dayname(pickup_datetime) AS day_name, count(*) AS total_trips,
                   {_money_avg('fare_amount')} AS avg_fare, {_money_avg('tip_amount')} AS avg_tip
            FROM trips_clean GROUP BY 1, 2 ORDER BY 1"""
    ),
    "monthly_trends": _with("SELECT * FROM monthly_trends ORDER BY month"),
    "monthly_revenue": _with(
        "SELECT month, total_trips, total_revenue AS revenue FROM monthly_trends ORDER BY month"
    ),
    "source_comparison": _with(
        f"""SELECT source, count(*) AS total_trips, {_money_avg('fare_amount')} AS avg_fare,
                   {_money_avg('tip_amount')} AS avg_tip, {_money_avg('trip_distance')} AS avg_distance,
                   {_money_sum('fare_amount')} AS total_revenue
            FROM trips_clean GROUP BY source"""
    ),
    "popular_pickup_zones": _with("SELECT * FROM popular_pickup_zones"),
    "top_pickup_zones": _with(
        """SELECT CAST(PULocationID AS VARCHAR) AS zone, PULocationID, total_pickups, avg_fare
           FROM popular_pickup_zones ORDER BY total_pickups DESC, PULocationID LIMIT 10"""
    ),
    "fare_distribution": _with(
        """, buckets(bucket_ord, fare_bucket) AS (
             VALUES (1, 'Under $10'), (2, '$10-$20'), (3, '$20-$30'),
                    (4, '$30-$50'), (5, '$50-$100'), (6, '$100+')
           ),
           binned AS (
             SELECT CASE WHEN fare_amount > 0 THEN
                      CASE WHEN fare_amount <= 10 THEN 1 WHEN fare_amount <= 20 THEN 2
                           WHEN fare_amount <= 30 THEN 3 WHEN fare_amount <= 50 THEN 4
                           WHEN fare_amount <= 100 THEN 5 WHEN fare_amount <= 999999 THEN 6 END
                    END AS bucket_ord
             FROM trips_union
           )
           SELECT b.fare_bucket, CAST(b.bucket_ord AS INTEGER) AS bucket_ord, count(x.bucket_ord) AS count
           FROM buckets b LEFT JOIN binned x ON x.bucket_ord = b.bucket_ord
           GROUP BY b.fare_bucket, b.bucket_ord ORDER BY b.bucket_ord"""
    ),
    "payment_types": _with("SELECT * FROM payment_types"),
    "payment_labels": _with("SELECT * FROM payment_labels"),
    "payment_share": _with(
        """SELECT payment_type, payment_label, total_trips,
                  CAST(floor((total_trips * 2000 + sum(total_trips) OVER ())
                             / (sum(total_trips) OVER () * 2)) AS BIGINT) / 10 AS share_pct
           FROM payment_labels"""
    ),
    "zone_demand": _with(
        f"""SELECT date_trunc('hour', pickup_datetime) AS window_start,
                   date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS window_end,
                   PULocationID, count(*) AS trip_count,
                   {_cents_avg_r2('fare_amount')} AS avg_fare,
                   {_money_sum('total_amount')} AS total_revenue
            FROM trips_stream_clean GROUP BY 1, 2, 3"""
    ),
    "daily_stats": _with(
        f"""SELECT strftime(pickup_datetime, '%Y-%m-%d') AS trip_date, count(*) AS total_trips,
                   {_cents_avg_r2('fare_amount')} AS avg_fare, {_cents_avg_r2('tip_amount')} AS avg_tip,
                   {_cents_avg_r2('trip_distance')} AS avg_distance,
                   {_money_sum('total_amount')} AS total_revenue
            FROM trips_stream_clean GROUP BY 1"""
    ),
    "payment_analysis": _with(
        f"""SELECT payment_type, count(*) AS trip_count,
                   {_cents_avg_r2('fare_amount')} AS avg_fare, {_cents_avg_r2('tip_amount')} AS avg_tip,
                   {_money_sum('total_amount')} AS total_revenue
            FROM trips_stream_clean GROUP BY payment_type"""
    ),
    "replay_split": _with(
        f"""SELECT *, CAST((row_number() OVER (ORDER BY {_REPLAY_ORDER}) - 1) // 5000 AS BIGINT) AS slice
            FROM trips_stream_norm"""
    ),
    "replay_shuffled": _with(
        f"""SELECT *, CAST((row_number() OVER (ORDER BY {_row_md5('42')}, {_REPLAY_ORDER}) - 1) // 5000 AS BIGINT) AS slice
            FROM trips_stream_norm"""
    ),
}
ORACLE_SQL["stream_zone_demand"] = ORACLE_SQL["zone_demand"]
ORACLE_SQL["stream_daily_stats"] = ORACLE_SQL["daily_stats"]
ORACLE_SQL["stream_payment"] = ORACLE_SQL["payment_analysis"]
ORACLE_SQL["stream_daily_windowed"] = ORACLE_SQL["daily_stats"]
ORACLE_SQL["stream_zone_demand_batches"] = ORACLE_SQL["zone_demand"]
ORACLE_SQL["stream_payment_csv"] = ORACLE_SQL["payment_analysis"]
ORACLE_SQL["stream_payment_memory"] = ORACLE_SQL["payment_analysis"]
ORACLE_SQL["monthly_trends_stored"] = ORACLE_SQL["monthly_trends"]
ORACLE_SQL["load_audit_stored"] = ORACLE_SQL["load_audit"]
ORACLE_SQL["trips_drifted"] = ORACLE_SQL["trips_union"]
# Four files a feed (fewer only for a handful of rows), one of each feed a batch; in event-time order nothing is late.
ORACLE_SQL["stream_late_rows"] = """
SELECT 'zone_demand' AS query, CAST(max(ceil(n / ceil(n / 4.0))) AS BIGINT) AS batches,
       CAST(sum(n) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS dropped_rows
FROM (SELECT count(*) AS n FROM events UNION ALL SELECT count(*) FROM lineitem)"""
ORACLE_SQL["stream_rejects"] = _with(
    """SELECT CAST(NULL AS VARCHAR) AS reason, count(*) AS lines FROM trips_stream_clean
       UNION ALL SELECT 'fare_amount', count(*) FROM trips_stream_norm
       WHERE PULocationID % 50 = 0 HAVING count(*) > 0
       UNION ALL SELECT 'pickup_datetime,fare_amount', count(*) FROM trips_stream_norm
       WHERE PULocationID % 50 = 1 HAVING count(*) > 0"""
)
ORACLE_SQL["stream_state_audit"] = _with(
    """SELECT 'zone_demand' AS query, count(*) AS groups, CAST(0 AS BIGINT) AS unfit
       FROM (SELECT DISTINCT date_trunc('hour', pickup_datetime), PULocationID FROM trips_stream_clean)
       UNION ALL SELECT 'daily_stats', count(*), CAST(0 AS BIGINT)
       FROM (SELECT DISTINCT CAST(pickup_datetime AS DATE) FROM trips_stream_clean)"""
)

"""Canonical trip table: names, types and the fixed constants of the analyses."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------

# Canonical column order (the stream schema declares the same ten columns in this order).
TRIP_COLUMNS = [
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
]

TRIP_TYPES = {
    "pickup_datetime": TimestampType(),
    "dropoff_datetime": TimestampType(),
    "passenger_count": DoubleType(),
    "trip_distance": DoubleType(),
    "PULocationID": IntegerType(),
    "DOLocationID": IntegerType(),
    "payment_type": IntegerType(),
    "fare_amount": DoubleType(),
    "tip_amount": DoubleType(),
    "total_amount": DoubleType(),
}

# Schema of the trip stream (no provenance column).
TRIPS = StructType([StructField(c, TRIP_TYPES[c], True) for c in TRIP_COLUMNS])

MONEY_COLUMNS = ("fare_amount", "tip_amount", "total_amount")

# Fare buckets: right-closed bins (0,10] (10,20] (20,30] (30,50] (50,100] (100,999999].
FARE_BUCKET_EDGES = [0, 10, 20, 30, 50, 100, 999999]
FARE_BUCKET_LABELS = ["Under $10", "$10-$20", "$20-$30", "$30-$50", "$50-$100", "$100+"]

# Payment code labels; any other code (and NULL) is "Other".
PAYMENT_LABELS = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute", 5: "Unknown"}
PAYMENT_OTHER = "Other"

# Candidate column names searched, in this order, for the revenue and tips series.
REVENUE_CANDIDATES = ["total_fare_revenue", "fare_revenue", "total_revenue", "revenue", "fare_amount"]
TIPS_CANDIDATES = ["total_tips", "tips", "tip_amount"]

# Batch cleaning limits.
MAX_FARE = 500
MIN_DURATION_MIN = 1
MAX_DURATION_MIN = 180

# Text forms of the time keys, and weekday names numbered as dayofweek numbers them (1 = Sunday).
MONTH_FORMAT = "yyyy-MM"
DATE_FORMAT = "yyyy-MM-dd"
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Streaming defaults: zone window and lateness, live trigger intervals, replay file size and seed,
# files taken per micro-batch; rows that one task sorts or writes when a whole feed is replayed.
ZONE_WINDOW = "1 hour"
ZONE_LATENESS = "10 minutes"
TRIGGERS = {"zone_demand": "10 seconds", "daily_stats": "15 seconds", "payment_analysis": "20 seconds"}
REPLAY_ROWS_PER_FILE = 5000
REPLAY_SEED = 42
MAX_FILES_PER_TRIGGER = 2
REPLAY_TASK_ROWS = 250_000

# Feed names (the values of ``source``) and the raw column that identifies each feed, checked in this order.
METERED = "yellow_taxi"
DISPATCH = "hvfhv"
FEED_MARKERS = [("tpep_pickup_datetime", METERED), ("pickup_datetime", DISPATCH)]

# Canonical column <- raw column of each feed in the batch job (None: typed NULL).
BATCH_MAPPING = {
    METERED: {
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "PULocationID": "PULocationID",
        "DOLocationID": "DOLocationID",
        "payment_type": "payment_type",
        "fare_amount": "fare_amount",
        "tip_amount": "tip_amount",
        "total_amount": "total_amount",
    },
    DISPATCH: {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "passenger_count": None,
        "trip_distance": "trip_miles",
        "PULocationID": "PULocationID",
        "DOLocationID": "DOLocationID",
        "payment_type": None,
        "fare_amount": "base_passenger_fare",
        "tip_amount": "tips",
        "total_amount": "driver_pay",
    },
}

# Canonical column <- raw column of each feed in the stream (kept when present).
STREAM_MAPPING = {
    METERED: dict(BATCH_MAPPING[METERED]),
    DISPATCH: {
        "pickup_datetime": "pickup_datetime",
        "dropoff_datetime": "dropoff_datetime",
        "trip_distance": "trip_miles",
        "PULocationID": "PULocationID",
        "DOLocationID": "DOLocationID",
        "tip_amount": "tips",
        "fare_amount": "base_passenger_fare",
    },
}

# Stream defaults for dispatch columns that are absent.
STREAM_DEFAULTS = {
    DISPATCH: {"passenger_count": 1, "payment_type": 1, "tip_amount": 0.0, "fare_amount": 0.0},
}

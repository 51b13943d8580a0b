"""The canonical trip table at rest: Parquet partitioned by source and month.

Normalising raw feeds once and storing the typed result lets every later job
read only what it needs: a filter on ``source`` or ``pickup_month`` prunes
whole directories, and rows sorted by pickup time inside each file give tight
min/max statistics, so a time-range filter skips row groups.

Writing: rows are range-partitioned on (source, month, pickup time, a unique
row id). The id makes every sort key distinct, so a month, an hour or a pile
of identical copies holding a third of all rows is still cut into many
similar-sized tasks instead of landing in one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.functions.timekeys import month_key

MONTH_COL = "pickup_month"
PARTITION_COLS = ["source", MONTH_COL]


def write_trip_table(
    trips: DataFrame,
    path: str,
    num_partitions: int | None = None,
    max_records_per_file: int = 5_000_000,
    mode: str = "overwrite",
    dynamic: bool = True,
) -> str:
    """Write (or add to) the table. With ``dynamic`` an overwrite replaces only
    the (source, month) partitions present in ``trips``: loading a month again
    is idempotent and leaves the other months as they are."""
    if "source" not in trips.columns:
        raise ValueError("the trip table needs the source column (batch layout)")
    n = num_partitions or int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    uid = "_row_uid"
    out = (
        trips.withColumn(MONTH_COL, month_key("pickup_datetime"))
        .withColumn(uid, F.monotonically_increasing_id())
        .repartitionByRange(n, "source", MONTH_COL, "pickup_datetime", uid)
        .sortWithinPartitions("source", MONTH_COL, "pickup_datetime")
        .drop(uid)
    )
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*PARTITION_COLS)
        .parquet(path)
    )
    return path


def read_trip_table(
    spark: SparkSession,
    path: str,
    sources: list[str] | None = None,
    months: tuple[str, str] | None = None,
) -> DataFrame:
    """The table, optionally restricted to some sources and an inclusive month range
    (both become partition filters)."""
    df = spark.read.parquet(path)
    if sources:
        df = df.filter(F.col("source").isin(list(sources)))
    if months:
        lo, hi = months
        df = df.filter((F.col(MONTH_COL) >= lo) & (F.col(MONTH_COL) <= hi))
    return df

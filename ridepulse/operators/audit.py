"""Load audit: what each feed delivered, in one aggregate pass.

Counting rows alone can be fooled: Spark prunes columns a count does not need,
so a file that fails to decode in one column is not read by ``count()`` but
is by the later analyses. The audit therefore aggregates every canonical
column (non-NULL counts and exact sums), which makes the scan decode them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.functions.money import money_sum
from ridepulse.functions.rowtext import row_md5
from ridepulse.schema import MONEY_COLUMNS, TRIP_COLUMNS


def checksum_sum(md5: Column) -> Column:
    """Sum of the first 32 bits of each row's MD5, as DECIMAL (it cannot overflow)."""
    return F.sum(F.conv(F.substring(md5, 1, 8), 16, 10).cast("decimal(20,0)"))


def load_audit(trips: DataFrame, by: str | list[str] = "source", checksum: bool = False) -> DataFrame:
    """Rows, non-NULL counts, time range and exact sums per key.

    ``checksum`` adds the sum of the first 32 bits of each row's MD5 (summed as
    DECIMAL, so it cannot overflow; given as text): a fingerprint of the rows in
    any order, sensitive to duplicates, to compare two loads of the same files.
    """
    keys = [by] if isinstance(by, str) else list(by)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(c).alias(f"nonnull_{c}") for c in TRIP_COLUMNS]
    aggs += [
        F.min("pickup_datetime").alias("min_pickup"),
        F.max("pickup_datetime").alias("max_pickup"),
        money_sum("trip_distance").alias("sum_distance"),
    ]
    aggs += [money_sum(c).alias(f"sum_{c}") for c in MONEY_COLUMNS]
    if checksum:
        aggs.append(checksum_sum(row_md5(trips, TRIP_COLUMNS)).cast("string").alias("checksum"))
    return trips.groupBy(*keys).agg(*aggs)

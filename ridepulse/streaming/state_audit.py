"""Check of a query's stored state against its saved result, from the checkpoint alone.

Spark's ``statestore`` source reads the state as of the last finished batch:
one row per group. Each group is one of

* ``equal``: in state and result, with the same number of trips;
* ``closed``: in the result only, its window behind the watermark of that
  batch, so its state was rightly dropped;
* ``differs``, ``unsaved`` (in the state only) or ``lost`` (in the result
  only, not closed): state and result do not belong together, as after a
  restored checkpoint, a result table of another run or an edited one.

Run it between the batches of a stopped query. State and result meet in one
grouping by key (NULL keys too), so a large state is checked in parallel.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ridepulse.sources import files

SOUND = ("equal", "closed")
# kind -> (key columns of the result, its number of trips, window end of a key or None)
_RESULTS = {
    "zone_demand": (["window_start", "window_end", "PULocationID"], "trip_count", "window_end"),
    "daily_stats": (["trip_date"], "total_trips", None),
    "payment_analysis": (["payment_type"], "trip_count", None),
}


def _key_columns(kind: str, state: DataFrame) -> list[Column]:
    if kind == "zone_demand":
        return [F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"), F.col("key.PULocationID")]
    name = state.schema["key"].dataType.fieldNames()[0]  # the one grouping key
    key = F.col("key").getField(name)
    return [F.date_format(key, "yyyy-MM-dd").alias("trip_date") if kind == "daily_stats" else key.alias("payment_type")]


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last finished batch of a checkpoint."""
    done = [int(n) for n in files.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        raise ValueError(f"no finished batch in {checkpoint}")
    return max(done)


def watermark(spark: SparkSession, checkpoint: str, batch: int) -> dt.datetime:
    """The watermark a batch ran with (1970 if the query has none), in UTC."""
    for line in files.read_text(spark, f"{checkpoint}/offsets/{batch}").splitlines():
        if "batchWatermarkMs" in line:
            return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=json.loads(line)["batchWatermarkMs"])
    raise ValueError(f"no watermark in the offsets of batch {batch}")


def state_groups(spark: SparkSession, checkpoint: str, kind: str, batch: int | None = None) -> DataFrame:
    """Key columns as in the result, and ``state_trips``, the number of trips kept per group."""
    at = last_batch(spark, checkpoint) if batch is None else batch
    state = spark.read.format("statestore").option("batchId", at).load(checkpoint)
    measures = state.schema["value"].dataType.fields  # sums and counts under repeated names: taken by position
    by_place = StructType([StructField(f"m{i}", f.dataType) for i, f in enumerate(measures)])
    return state.select(*_key_columns(kind, state), F.col("value").cast(by_place)["m0"].alias("state_trips"))


def audit_state(spark: SparkSession, checkpoint: str, result: DataFrame, kind: str) -> DataFrame:
    """``finding`` and number of ``groups`` of one query (``zone_demand``, ``daily_stats``, ``payment_analysis``)."""
    keys, trips, end = _RESULTS[kind]
    batch = last_batch(spark, checkpoint)
    none = F.lit(None).cast("long")
    stored = state_groups(spark, checkpoint, kind, batch).withColumn("saved_trips", none)
    saved = result.select(*keys, none.alias("state_trips"), F.col(trips).alias("saved_trips"))
    both = stored.unionByName(saved).groupBy(*keys).agg(F.max("state_trips").alias("s"), F.max("saved_trips").alias("r"))
    closed = F.col(end) <= F.lit(watermark(spark, checkpoint, batch)) if end else F.lit(False)
    finding = (
        F.when(F.col("s") == F.col("r"), "equal")
        .when(F.col("r").isNull(), "unsaved")
        .when(F.col("s").isNotNull(), "differs")
        .when(closed, "closed")
        .otherwise("lost")
    )
    return both.groupBy(finding.alias("finding")).agg(F.count(F.lit(1)).alias("groups"))

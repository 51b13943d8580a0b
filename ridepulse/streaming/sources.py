"""Streaming sources of trips.

* ``canonical_stream``: files already in the canonical trip layout (written by
  ``ridepulse.operators.replay``), Parquet or CSV. CSV is read by header name
  with ``enforceSchema=false``, so a file whose columns are in another order
  fails instead of silently mis-assigning values.
* ``feed_stream``: raw files of one feed (one file stream per feed), mapped by
  the stream normaliser; two of them are combined with ``unionByName``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ridepulse.operators.normalize import drop_incomplete, normalise_stream, union_trips
from ridepulse.schema import TRIPS


SOURCE_FIELD = StructField("source", StringType(), True)


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A file stream. The admission limits bound each micro-batch, so a backlog
    (first start, catch-up after downtime) is taken in steps, not in one batch."""
    reader = spark.readStream.schema(schema).options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
        return reader.csv(path)
    return reader.format(fmt).load(path)


def canonical_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    with_source: bool = False,
) -> DataFrame:
    """Trips already in the canonical layout (replay files), as a stream; ``with_source`` for files that name each trip's feed."""
    return file_stream(
        spark, path, StructType([*TRIPS, SOURCE_FIELD]) if with_source else TRIPS, fmt,
        max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger,
    )


def names_source(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether the files of a folder name each trip's feed (a ``source`` column); False while it has no files."""
    try:
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        return "source" in reader.format(fmt).load(path).columns
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def routed_stream(open_stream: Callable[[], DataFrame], feeds: list[str], lateness: str) -> DataFrame:
    """One stream of trips of several feeds, each with its own watermark, from files that hold all of them.

    ``open_stream`` gives the stream of the files (with ``source``); it is read
    once per feed, filtered by source in the scan. Spark follows the slowest
    feed (``spark.sql.streaming.multipleWatermarkPolicy`` = min, set when a
    query starts): a trip is late only behind the newest trips of its own
    feed and of every other one. A feed without a single trip holds all
    windows open, so ``feeds`` names those that come. Trips of a feed that is
    not named fail the query rather than being left out.
    """
    named = F.col("source").isin(feeds)
    checked = F.when(named, F.col("source")).otherwise(
        F.raise_error(F.concat(F.lit("trip of a feed that the job does not name: "), F.coalesce("source", F.lit("none"))))
    )
    parts = []
    for i, feed in enumerate(feeds):
        rows = open_stream()
        rows = rows.where((checked if i == 0 else F.col("source")) == feed).drop("source")
        parts.append(rows.withWatermark("pickup_datetime", lateness))
    return union_trips(parts)


def feed_stream(
    spark: SparkSession,
    path: str,
    feed: str,
    raw_schema: StructType,
    glob: str | None = None,
    bind: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream-normalised trips of one feed; ``bind`` maps stored rows to raw feed columns."""
    raw = file_stream(spark, path, raw_schema, "parquet", glob, max_files_per_trigger)
    if bind is not None:
        raw = bind(raw)
    return normalise_stream(raw, feed)


def trips_stream(streams: list[DataFrame], lateness: str | None = None) -> DataFrame:
    """Union of per-feed streams, without rows lacking pickup time or fare.

    ``lateness`` gives every feed its own watermark before the union. Spark then
    follows the slowest feed, so a feed whose data are newer makes no row of
    another feed late, however the input is cut into micro-batches.
    """
    if lateness:
        streams = [s.withWatermark("pickup_datetime", lateness) for s in streams]
    return drop_incomplete(union_trips(streams))

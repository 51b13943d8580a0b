"""CSV trip files line by line: good lines become trips, damaged ones are kept as rejects.

A plain CSV stream gives NULL for a value it cannot read, so a trip with a
damaged tip still counts and one with a damaged time disappears with the rows
that lack one. Here every column is read as text and cast: a line is damaged
if a value that is there cannot be cast to its column's type, or if it has
another number of fields than the header. The test looks at all columns,
whichever of them a query goes on to use, so every query over a folder takes
the same lines. Damaged lines go to a table of their own (``start_rejects``,
an exactly-once file sink): file, reason, text.

A file whose header does not fit is no matter of single lines and fails the
query, as before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ridepulse.schema import TRIPS
from ridepulse.streaming.queries import StreamPaths, Trigger
from ridepulse.streaming.sources import SOURCE_FIELD, file_stream

RECORD = "_record"
REJECTS_SCHEMA = "file string, reason string, record string"
FIELD_COUNT = "number of fields"


def _schema(with_source: bool) -> StructType:
    return StructType([*TRIPS, SOURCE_FIELD]) if with_source else TRIPS


def csv_lines(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    with_source: bool = False,
) -> DataFrame:
    """The lines of canonical CSV files as a stream: every column as text, and the
    whole line (``_record``) where its number of fields is not the header's."""
    texts = [StructField(f.name, StringType(), True) for f in _schema(with_source)]
    return file_stream(
        spark, path, StructType([*texts, StructField(RECORD, StringType(), True)]), "csv",
        max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger,
        options={"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD},
    )


def _damaged(field: StructField) -> Column:
    text = F.col(field.name)
    return text.isNotNull() & text.try_cast(field.dataType).isNull()


def reason(with_source: bool = False) -> Column:
    """Names of the columns that cannot be read, in order, or ``FIELD_COUNT``; NULL for a good line."""
    names = F.concat_ws(",", *[F.when(_damaged(f), F.lit(f.name)) for f in _schema(with_source)])
    return F.when(F.col(RECORD).isNotNull(), F.lit(FIELD_COUNT)).otherwise(F.nullif(names, F.lit("")))


def good_trips(lines: DataFrame) -> DataFrame:
    """Typed trips of the lines that are not damaged."""
    schema = _schema(SOURCE_FIELD.name in lines.columns)
    whole = lines.where(reason(SOURCE_FIELD.name in lines.columns).isNull())
    return whole.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def rejected_lines(lines: DataFrame) -> DataFrame:
    """File, reason and text of the damaged lines (text as read again from its fields, where their number fits)."""
    with_source = SOURCE_FIELD.name in lines.columns
    fields = F.to_csv(F.struct(*[f.name for f in _schema(with_source)]))
    why = reason(with_source)
    return lines.where(why.isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), why.alias("reason"), F.coalesce(RECORD, fields).alias("record")
    )


def start_rejects(lines: DataFrame, paths: StreamPaths, trigger: Trigger, name: str = "rejects") -> StreamingQuery:
    """Write the damaged lines of every micro-batch, each once, to ``paths.output``."""
    writer = (
        rejected_lines(lines).writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("path", paths.output)
        .option("checkpointLocation", paths.checkpoint)
    )
    return writer.trigger(**trigger.kwargs()).start() if trigger.kwargs() else writer.start()


def read_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """The damaged lines so far; none before the first micro-batch."""
    try:
        return spark.read.schema(REJECTS_SCHEMA).parquet(out_dir)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTS_SCHEMA)

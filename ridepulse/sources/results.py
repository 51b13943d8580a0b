"""Writing result tables and reading them back.

Results are written by the executors (no ``toPandas`` through the driver):
Parquet for further processing, CSV with a header for people. Small
aggregates may be written as a single file; large ones keep their partitions.
"""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridepulse.schema import TRIP_COLUMNS, TRIP_TYPES


_LOG = logging.getLogger(__name__)


class MissingColumns(ValueError):
    """A result lacks columns its reader needs."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Fail early, naming the columns a result lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; have {df.columns}")
    return df


def write_result(
    df: DataFrame, out_dir: str, fmt: str = "csv", single_file: bool = False, mode: str = "overwrite"
) -> str:
    """Write a result table; ``single_file`` only for small aggregates."""
    data = df.coalesce(1) if single_file else df
    writer = data.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(out_dir)
    elif fmt == "parquet":
        writer.parquet(out_dir)
    else:
        writer.format(fmt).save(out_dir)
    return out_dir


def read_result_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """A result CSV with header, or None when it is missing, empty or unreadable."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    try:
        df = reader.csv(path)
        empty = not df.columns or df.isEmpty()
    except (PySparkException, Py4JJavaError) as exc:  # no such path, a damaged file, columns in another order ...
        _LOG.warning("cannot read %s: %s", path, str(exc).splitlines()[0][:300] if str(exc) else type(exc).__name__)
        return None
    return None if empty else df


def read_trip_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Trip CSV in canonical column order; a header in any other order fails
    (``enforceSchema=false``) instead of assigning values to the wrong columns."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_trip_csv_by_name(spark: SparkSession, path: str) -> DataFrame:
    """Trip CSV whose columns may come in any order: columns are taken by header
    name (as text, no inference pass) and cast to the canonical types."""
    raw = spark.read.option("header", True).csv(path)
    cols = [
        (F.col(c) if c in raw.columns else F.lit(None)).try_cast(TRIP_TYPES[c]).alias(c) for c in TRIP_COLUMNS
    ]
    return raw.select(*cols)

"""A row's values as one text, and a hash of it that any SQL engine can compute again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, TimestampType

MISSING = "~"


def _text(name: str, kind) -> Column:
    col = F.col(name)
    if isinstance(kind, TimestampType):
        col = F.unix_micros(col)
    elif isinstance(kind, (DoubleType, FloatType, DecimalType)):
        col = col.try_cast("decimal(38,6)")
    return F.coalesce(col.cast("string"), F.lit(MISSING))


def row_md5(df: DataFrame, columns: list[str], prefix: str = "") -> Column:
    """MD5 (hex) of ``prefix`` and the columns' texts, each after a bar.

    Timestamps are microseconds since the epoch, fractions have six decimals
    (NaN and infinities count as missing), NULL is ``~``.
    """
    return F.md5(F.concat(F.lit(prefix), *[F.concat(F.lit("|"), _text(c, df.schema[c].dataType)) for c in columns]))

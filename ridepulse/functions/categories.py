"""Fare buckets and payment labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridepulse.schema import (
    FARE_BUCKET_EDGES,
    FARE_BUCKET_LABELS,
    PAYMENT_LABELS,
    PAYMENT_OTHER,
)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fare_bucket_ord(col: str | Column = "fare_amount") -> Column:
    """1..6 for the right-closed bins; NULL outside (0, 999999] or for NULL."""
    c = _c(col)
    expr = None
    for i, hi in enumerate(FARE_BUCKET_EDGES[1:], start=1):
        cond = c <= F.lit(hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.when(c > F.lit(FARE_BUCKET_EDGES[0]), expr)


def fare_bucket_label(ord_col: str | Column = "bucket_ord") -> Column:
    """Label of a bucket number (NULL for NULL)."""
    # A map lookup: NULL in, NULL out. (``element_at`` on a literal array with a
    # NULL index returned the last element in Spark 4.1.)
    pairs = []
    for i, label in enumerate(FARE_BUCKET_LABELS, start=1):
        pairs += [F.lit(i), F.lit(label)]
    return F.create_map(*pairs)[_c(ord_col)]


def payment_label(col: str | Column = "payment_type") -> Column:
    """Label of a payment code; unknown codes and NULL give "Other"."""
    pairs = []
    for code, label in PAYMENT_LABELS.items():
        pairs += [F.lit(code), F.lit(label)]
    return F.coalesce(F.create_map(*pairs)[_c(col)], F.lit(PAYMENT_OTHER))

"""Sums and averages of money and distances that lose no value.

Measures are DOUBLE in the trip table (as the feeds deliver them). A plain sum
of doubles depends on the order in which partial aggregates are merged, so
each value is split in two parts that are summed apart: its whole cents
(BIGINT, exact in any order) and the rest (DOUBLE; what is finer than a cent,
and the whole of a value too large for the cents, of NaN and of infinities).
The two sums together are the plain sum: no value is cut or rounded. For
values recorded in hundredths the rest is 0 and the result is exact, on one
executor or a thousand. The split is primitive arithmetic inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values below this are split into cents and rest; 9e10 rows of it still fit a BIGINT sum.
_SPLIT_BELOW = 1e6


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: str | Column) -> Column:
    """Whole cents of a value, rounded half up; 0 when the value is all rest, NULL when it is NULL."""
    c = _c(col).cast("double")
    whole = F.when(F.abs(c) < F.lit(_SPLIT_BELOW), F.floor(c * 100 + 0.5))
    return whole.when(c.isNotNull(), F.lit(0).cast("bigint"))


def rest(col: str | Column) -> Column:
    """What ``cents`` leaves of a value, as DOUBLE."""
    return _c(col).cast("double") - cents(col) / 100


def join_parts(cents_sum: Column, rest_sum: Column) -> Column:
    """The sum whose two parts were added up apart."""
    return cents_sum / 100 + rest_sum


def money_sum(col: str | Column) -> Column:
    """Sum of a column, as DOUBLE."""
    return join_parts(F.sum(cents(col)), F.sum(rest(col)))


def money_avg(col: str | Column) -> Column:
    """Sum over the non-NULL count, as DOUBLE."""
    return money_sum(col) / F.nullif(F.count(_c(col)), F.lit(0))


def money_avg_r2(col: str | Column) -> Column:
    """Average rounded half up (away from zero) to cents.

    Without a rest the one decimal division happens per group, after the
    aggregate; with the sum as DECIMAL(20,0) Spark keeps 18 fraction digits, so
    the rounding is exact for any realistic count. Otherwise the DOUBLE average
    is rounded.
    """
    whole, n = F.sum(cents(col)), F.nullif(F.count(_c(col)), F.lit(0))
    exact = F.round(whole.cast("decimal(20,0)") / n, 0).cast("double") / 100
    return F.when(F.sum(rest(col)) == 0, exact).otherwise(F.round(money_avg(col), 2))


def money_sum_r2(col: str | Column) -> Column:
    """Sum rounded to cents, as DOUBLE."""
    return F.round(money_sum(col), 2)

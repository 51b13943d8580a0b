"""Raw feed -> canonical trip table.

Two feeds with different column names are mapped onto one schema. There are
two normalisers, because batch and stream treat the dispatch feed differently:

* ``batch``: dispatch ``passenger_count`` / ``payment_type`` are typed NULL and
  ``total_amount`` is the driver pay; every row carries a ``source`` tag.
* ``stream``: dispatch ``passenger_count`` / ``payment_type`` default to 1,
  absent fare / tip default to 0.0, ``total_amount`` is fare + tip, rows
  without pickup time or fare are dropped, and there is no ``source`` column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridepulse.schema import (
    BATCH_MAPPING,
    DISPATCH,
    FEED_MARKERS,
    METERED,
    STREAM_DEFAULTS,
    STREAM_MAPPING,
    TRIP_COLUMNS,
    TRIP_TYPES,
)

__all__ = ["METERED", "DISPATCH", "BATCH_MAPPING", "STREAM_MAPPING"]

def detect_feed(columns: Iterable[str]) -> str | None:
    """The feed a file belongs to, from its column names (None: unknown)."""
    cols = set(columns)
    for marker, feed in FEED_MARKERS:
        if marker in cols:
            return feed
    return None


def missing_batch_columns(feed: str, columns: Iterable[str]) -> list[str]:
    """Raw columns the batch normaliser needs that a file does not have."""
    have = set(columns)
    return [src for src in BATCH_MAPPING[feed].values() if src is not None and src not in have]


def _typed(expr: Column, name: str) -> Column:
    return expr.cast(TRIP_TYPES[name]).alias(name)


def normalise_batch(
    raw: DataFrame, feed: str, tag: str | None = None, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Rename + cast one feed to the canonical columns and tag its source.

    ``extra`` names raw columns carried through unchanged (e.g. the file path).
    """
    mapping = BATCH_MAPPING[feed]
    missing = missing_batch_columns(feed, raw.columns)
    if missing:
        raise ValueError(f"{feed} feed lacks columns {missing}")
    cols = [
        _typed(F.lit(None) if src is None else F.col(src), dst) for dst, src in mapping.items()
    ]
    return raw.select(*cols, F.lit(tag or feed).alias("source"), *extra)


def normalise_stream(raw: DataFrame, feed: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Canonical stream columns from one feed (no source tag, no row filter)."""
    mapping = STREAM_MAPPING[feed]
    present = {dst: src for dst, src in mapping.items() if src in raw.columns}
    defaults = STREAM_DEFAULTS.get(feed, {})
    exprs: dict[str, Column] = {}
    for name in TRIP_COLUMNS:
        if name in present:
            exprs[name] = F.col(present[name])
        elif name in defaults:
            exprs[name] = F.lit(defaults[name])
        else:
            exprs[name] = F.lit(None)
    if feed == DISPATCH:
        exprs["total_amount"] = exprs["fare_amount"].cast("double") + exprs["tip_amount"].cast("double")
    return raw.select(*[_typed(exprs[n], n) for n in TRIP_COLUMNS], *extra)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without pickup time or fare cannot be streamed."""
    return df.dropna(subset=["pickup_datetime", "fare_amount"])


def union_trips(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union by column name."""
    if not frames:
        raise ValueError("no trip frames to combine")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def trips_batch(raw_metered: DataFrame, raw_dispatch: DataFrame) -> DataFrame:
    """Both feeds, batch layout, combined."""
    return union_trips(
        [normalise_batch(raw_metered, METERED), normalise_batch(raw_dispatch, DISPATCH)]
    )


def trips_stream(raw_metered: DataFrame, raw_dispatch: DataFrame) -> DataFrame:
    """Both feeds, stream layout, combined, rows without pickup time or fare dropped."""
    return drop_incomplete(
        union_trips(
            [normalise_stream(raw_metered, METERED), normalise_stream(raw_dispatch, DISPATCH)]
        )
    )

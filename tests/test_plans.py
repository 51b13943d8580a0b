"""Plan properties that must hold at any scale, checked on every batch key."""

from __future__ import annotations

import contextlib
import io

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from ridepulse.plans.catalog import QUERIES

BATCH_KEYS = sorted(k for k in QUERIES if not k.startswith("stream_") and not k.startswith("replay_"))
# Columns of the generated tables no key needs: they must never be read.
UNUSED = ["l_returnflag", "l_linestatus", "l_comment"]


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")  # node details in full, not abbreviated
    return buf.getvalue()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_plan_shape(spark, key):
    plan = _formatted(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan  # no key joins two data-sized sides
    for col in UNUSED:
        assert col not in plan, f"{key} reads {col}"
    if "hashpartitioning" in plan and "HashAggregate" in plan:
        assert "partial_" in plan, f"{key}: aggregate without a partial stage"


CLEANED_KEYS = ["trips_clean", "peak_hours", "daily_patterns", "monthly_trends", "monthly_revenue",
                "source_comparison"]


@pytest.mark.parametrize("key", CLEANED_KEYS)
def test_cleaning_filter_reaches_the_scan(spark, key):
    plan = _formatted(E.queries()[key](spark, SF_SMALL))
    # trip_distance > 0 on the dispatch feed is l_quantity > 0, pushed into the Parquet scan
    assert "GreaterThan(l_quantity,0.0)" in plan


def test_top_k_is_take_ordered(spark):
    plan = _formatted(E.queries()["top_pickup_zones"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("key", ["peak_hours", "daily_patterns", "monthly_trends", "monthly_revenue"])
def test_bounded_results_sorted_without_range_partitioning(spark, key):
    plan = _formatted(E.queries()[key](spark, SF_SMALL))
    assert "rangepartitioning" not in plan and "SinglePartition" in plan


def test_month_bounds_reach_the_raw_scan(spark, tmp_dir):
    """Months given to the batch job are pushed to the scan of raw files as time bounds."""
    from ridepulse.plans import batch_job
    from ridepulse.sources import testdata

    testdata.raw_dispatch(spark, SF_SMALL).write.parquet(f"{tmp_dir}/raw")
    trips = batch_job.load_trips(spark, raw=[f"{tmp_dir}/raw"], months=("1995-03", "1995-12"))
    scan = next(line for line in _formatted(trips).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(pickup_datetime,1995-03-01" in scan
    assert "LessThan(pickup_datetime,1996-01-01" in scan

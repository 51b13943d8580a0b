"""Results do not change with the partitioning of the input."""

from __future__ import annotations

from conftest import SF_MID
from helpers import as_set

from ridepulse.operators import running, summaries
from ridepulse.operators.clean import clean, clean_stream
from ridepulse.plans import catalog


def test_batch_summaries_invariant_under_repartition(spark):
    trips = catalog.trips_union(spark, SF_MID)
    for fn in (summaries.peak_hours, summaries.daily_patterns, summaries.monthly_trends,
               summaries.source_comparison):
        a = fn(clean(trips))
        b = fn(clean(trips.repartition(7)))
        assert as_set(a) == as_set(b), fn.__name__


def test_running_stats_invariant_under_repartition(spark):
    trips = catalog.trips_stream_norm(spark, SF_MID)
    for fn in (running.daily_stats, running.payment_analysis):
        assert as_set(fn(clean_stream(trips))) == as_set(fn(clean_stream(trips.repartition(5)))), fn.__name__

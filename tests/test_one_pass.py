"""The one-scan batch plan gives exactly the per-key results."""

from __future__ import annotations

from conftest import SF_MID
from helpers import as_set

from ridepulse.plans import catalog, one_pass


def test_one_pass_equals_each_key(spark):
    trips = catalog.trips_union(spark, SF_MID)
    sets = one_pass.summary_sets(trips).cache()
    try:
        results = one_pass.results_from_sets(sets)
        assert len(results) == 13
        for key, df in results.items():
            want = catalog.QUERIES[key](spark, SF_MID)
            assert df.columns == want.columns, key
            assert as_set(df) == as_set(want), key
    finally:
        sets.unpersist()


def test_one_pass_scans_once(spark):
    trips = catalog.trips_union(spark, SF_MID)
    plan = one_pass.summary_sets(trips)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # one scan per feed, no more
    assert "Expand" in plan

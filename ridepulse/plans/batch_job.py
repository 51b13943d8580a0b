"""The batch job: load both feeds, clean, compute every summary, write each once.

    python -m ridepulse.plans.batch_job --raw 'hdfs:///trips/raw/*.parquet' --out hdfs:///trips/results
    python -m ridepulse.plans.batch_job --raw 'hdfs:///trips/raw/*.parquet' --write-table hdfs:///trips/table
    python -m ridepulse.plans.batch_job --table hdfs:///trips/table --months 2023-01:2023-06 --out ...
    python -m ridepulse.plans.batch_job --table hdfs:///trips/table --summaries hdfs:///trips/summaries --out ...
    python -m ridepulse.plans.batch_job --sf-dir /root/testdata/sf0.1 --out /tmp/results

All thirteen results come from one scan of the trips: a grouping-sets
aggregate (``ridepulse.plans.one_pass``) whose rows (bounded by months x
weekdays x hours x feeds x buckets, plus zones and payment codes) are kept in
memory while the results are written. With ``--summaries`` that aggregate is
kept per month of a stored trip table, and a run reads only the months whose
files changed since the last one. With ``--file-audit`` the same scan audits
every raw file (``load_audit_by_file``).
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.functions.timekeys import in_months
from ridepulse.operators import normalize
from ridepulse.plans import one_pass
from ridepulse.plans.stored import StoredSummaries
from ridepulse.session import build_session, prepare
from ridepulse.sources import testdata
from ridepulse.sources.feeds import scan_feeds, suggest_partitions
from ridepulse.sources.manifest import FileManifest
from ridepulse.sources.results import write_result
from ridepulse.sources.trip_table import MONTH_COL, read_trip_table, write_trip_table


# Rejected files named in a report.
REPORTED = 1000


def load_trips(
    spark: SparkSession,
    raw: list[str] | None = None,
    sf_dir: str | None = None,
    table: str | None = None,
    sources: list[str] | None = None,
    months: tuple[str, str] | None = None,
    allow_rejected: bool = False,
    rejected: list | None = None,
    manifest: str | None = None,
    with_file: bool = False,
) -> DataFrame:
    """Canonical trips from a stored trip table (pruned by source / month), raw
    feed files, or the generated tables.

    Raw files that cannot be used fail the load, unless ``allow_rejected``;
    then the first ``REPORTED`` of them are appended to ``rejected`` with their
    reasons, and their number, if there are more. ``manifest``: folder of a
    file manifest, by which only new files' footers are opened."""
    if table:
        return read_trip_table(spark, table, sources, months).drop(MONTH_COL)
    if raw:
        scan = FileManifest(spark, manifest).scan(raw, with_file=with_file) if manifest else scan_feeds(spark, raw, with_file=with_file)
        unused = [(r.path, r.reason) for r in scan.rejected.take(REPORTED)]
        if len(unused) == REPORTED:
            unused.append(("...", f"{scan.rejected.count()} files in all"))
        if unused and not allow_rejected:
            raise ValueError(f"raw files cannot be used (allow_rejected loads the others): {unused[:20]}")
        if rejected is not None:
            rejected += unused
        trips = scan.trips
    elif sf_dir:
        trips = normalize.trips_batch(testdata.raw_metered(spark, sf_dir), testdata.raw_dispatch(spark, sf_dir))
    else:
        raise ValueError("give a trip table, raw feed paths or a generated-table folder")
    if sources:
        trips = trips.filter(F.col("source").isin(list(sources)))
    if months:
        trips = trips.filter(in_months("pickup_datetime", *months))
    return trips


def batch_results(trips: DataFrame, by_file: bool = False) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(set aggregate, every batch result). One scan of ``trips`` computes the
    aggregate; its size is bounded by the key domains, not by the number of
    trips, so it is the thing kept in memory, not the trips."""
    sets = one_pass.summary_sets(trips, by_file=by_file).persist(StorageLevel.MEMORY_AND_DISK)
    return sets, one_pass.results_from_sets(sets)


def run(
    spark: SparkSession,
    out_dir: str,
    raw: list[str] | None = None,
    sf_dir: str | None = None,
    show: int = 0,
    table: str | None = None,
    sources: list[str] | None = None,
    months: tuple[str, str] | None = None,
    formats: tuple[str, ...] = ("csv", "parquet"),
    allow_rejected: bool = False,
    manifest: str | None = None,
    summaries: str | None = None,
    file_audit: bool = False,
) -> dict:
    """Write every result under ``out_dir/<format>/<name>`` (CSV with a header
    for people, Parquet beside it for further processing).

    ``summaries``: folder of stored summaries of the trip table ``table``,
    brought up to date first; the report names the months that were read for it.
    ``file_audit``: also the load audit of every raw file."""
    prepare(spark)
    t0 = time.time()
    rejected: list = []
    extra = {}
    if summaries:
        if not table or file_audit:
            raise ValueError("stored summaries are those of a trip table, without an audit of raw files")
        store = StoredSummaries(spark, summaries)
        extra["parts_read"] = store.update(table).read
        sets = store.sets(sources, months).persist(StorageLevel.MEMORY_AND_DISK)
        results = one_pass.results_from_sets(sets)
    else:
        if file_audit and not raw:
            raise ValueError("an audit by file needs raw files")
        trips = load_trips(spark, raw, sf_dir, table, sources, months, allow_rejected, rejected, manifest, with_file=file_audit)
        sets, results = batch_results(trips, file_audit)
    timings = {}
    try:
        t = time.time()
        sets.count()  # the one scan
        timings["_scan_and_aggregate"] = round(time.time() - t, 3)
        for name, df in results.items():
            t = time.time()
            # Every result is small (one row per hour / day / month / zone / code).
            for fmt in formats:
                write_result(df, f"{out_dir.rstrip('/')}/{fmt}/{name}", fmt, single_file=True)
            timings[name] = round(time.time() - t, 3)
            if show:
                print(f"== {name}")
                df.show(show, truncate=False)
    finally:
        sets.unpersist()
    return {"seconds": round(time.time() - t0, 3), "per_result": timings, "rejected": rejected, **extra}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", nargs="*", help="raw feed files or globs (both feeds)")
    ap.add_argument("--sf-dir", help="folder of generated tables bound to the two feeds")
    ap.add_argument("--table", help="stored trip table (see --write-table) to analyse")
    ap.add_argument("--sources", nargs="*", help="only these feeds (partition filter on a stored table)")
    ap.add_argument("--months", help="FROM:TO inclusive, e.g. 2023-01:2023-06 (partition filter)")
    ap.add_argument("--write-table", help="store the normalised trips here (partitioned by source, month) and exit")
    ap.add_argument("--out")
    ap.add_argument("--show", type=int, default=0, help="print the first N rows of each result")
    ap.add_argument("--formats", default="csv,parquet", help="comma-separated result formats")
    ap.add_argument("--allow-rejected", action="store_true", help="go on without raw files that cannot be used; the report names them")
    ap.add_argument("--manifest", help="folder of a manifest of the raw files: only new files' footers are opened")
    ap.add_argument("--summaries", help="folder of stored summaries of --table: only months that changed are read")
    ap.add_argument("--file-audit", action="store_true", help="audit every raw file (rows, sums, checksum) in the same scan")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, "ridepulse-batch")
    months = tuple(args.months.split(":", 1)) if args.months else None
    if args.summaries and not args.table:
        ap.error("--summaries needs --table")
    if args.file_audit and not args.raw:
        ap.error("--file-audit needs --raw")
    if args.write_table:
        rejected: list = []
        trips = load_trips(spark, args.raw, args.sf_dir, allow_rejected=args.allow_rejected, rejected=rejected, manifest=args.manifest)
        write_trip_table(trips, args.write_table, num_partitions=suggest_partitions(trips))
        print(json.dumps({"table": args.write_table, "rejected": rejected}))
        return
    if not args.out:
        ap.error("--out is required")
    formats = tuple(f for f in args.formats.split(",") if f)
    report = run(
        spark, args.out, args.raw, args.sf_dir, args.show, args.table, args.sources, months, formats,
        args.allow_rejected, args.manifest, args.summaries, args.file_audit,
    )
    print(json.dumps(report))


if __name__ == "__main__":
    main()

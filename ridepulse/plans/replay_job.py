"""Write trips as a sequence of N-row files for a file stream to replay.

    python -m ridepulse.plans.replay_job --raw 'hdfs:///trips/raw/*.parquet' \
        --out hdfs:///trips/stream --rows-per-file 5000 --format csv
    python -m ridepulse.plans.replay_job --sf-dir /root/testdata/sf0.01 --out /tmp/stream

Rows are normalised with the stream normaliser (both feeds), put in
event-time order (default; a watermark then drops nothing) or in a seeded
shuffle, and written one file per slice in ascending order, so a file stream
with ``maxFilesPerTrigger`` takes them in that order. Every row is written
exactly once. The timed drip of the original producer is left to the
stream's trigger interval and admission limits.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from ridepulse.operators import normalize, replay
from ridepulse.schema import REPLAY_ROWS_PER_FILE, REPLAY_SEED
from ridepulse.session import build_session
from ridepulse.sources import testdata
from ridepulse.sources.feeds import scan_feeds, suggest_partitions


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", nargs="*", help="raw feed files or globs (both feeds)")
    ap.add_argument("--sf-dir", help="folder of generated tables bound to the two feeds")
    ap.add_argument("--out", required=True)
    ap.add_argument("--rows-per-file", type=int, default=REPLAY_ROWS_PER_FILE)
    ap.add_argument("--order", default=replay.EVENT_TIME, choices=[replay.EVENT_TIME, replay.SHUFFLE])
    ap.add_argument("--seed", type=int, default=REPLAY_SEED)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--partitions", default=None,
                    help="range partitions of the global sort: a number, or 'auto' (sized from the input files)")
    ap.add_argument("--with-source", action="store_true", help="name each trip's feed, for a watermark per feed in the stream")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, "ridepulse-replay")
    if args.raw:
        scan = scan_feeds(spark, args.raw, layout="stream", with_source=args.with_source)
        trips = scan.trips
        rejected = [r.path for r in scan.rejected.collect()]
    elif args.sf_dir:
        raw = {normalize.METERED: testdata.raw_metered(spark, args.sf_dir), normalize.DISPATCH: testdata.raw_dispatch(spark, args.sf_dir)}
        feeds = [normalize.normalise_stream(df, feed).withColumn("source", F.lit(feed)) for feed, df in raw.items()]
        trips = normalize.drop_incomplete(normalize.union_trips(feeds))
        if not args.with_source:
            trips = trips.drop("source")
        rejected = []
    else:
        ap.error("give --raw or --sf-dir")
    if args.partitions == "auto":
        partitions = suggest_partitions(trips)
    else:
        partitions = int(args.partitions) if args.partitions else None
    files = replay.write_replay(
        trips, args.out, args.rows_per_file, args.order, args.seed, args.format, num_partitions=partitions
    )
    report = {"files": files, "out": args.out, "rejected_inputs": rejected}
    print(json.dumps(report))
    return report


if __name__ == "__main__":
    main()

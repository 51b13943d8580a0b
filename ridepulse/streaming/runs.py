"""Run a streaming aggregation to the end of its input and read its table.

``availableNow`` processes every file present at start (in as many
micro-batches as the source's rate limit asks for) and stops; the result is
then read back from the sink's table. Checkpoint and output live in a fresh
folder under the session's shared work folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ridepulse.operators import running
from ridepulse.operators.clean import clean_stream
from ridepulse.operators.normalize import DISPATCH, METERED, normalise_stream
from ridepulse.operators.replay import write_replay
from ridepulse.schema import MAX_FILES_PER_TRIGGER, REPLAY_TASK_ROWS, ZONE_LATENESS
from ridepulse.session import new_work_dir
from ridepulse.sources import testdata
from ridepulse.streaming import queries as sq
from ridepulse.streaming.sinks import read_latest, read_snapshot
from ridepulse.streaming.sources import canonical_stream, feed_stream, trips_stream

ZONE_KEYS = sq.ZONE_KEYS

# Heap that Spark's in-memory state takes for a group of a replayed zone-demand stream, in bytes
# (5.7 GB were reported for 41.6 million groups), and the share of the heap that state may fill.
STATE_GROUP_BYTES = 140
STATE_HEAP_SHARE = 0.5
# State on the executors' disks. Native memory is bounded per executor; a commit stores the changed
# files, so the state can be read back (audited) without replaying a log of changes.
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
DISK_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.changelogCheckpointing.enabled": "false",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.maxMemoryUsageMB": "1000",
}


def executor_heap(spark: SparkSession) -> int:
    """Bytes of heap of all executors there are now (of the driver in local mode)."""
    sc = spark.sparkContext._jsc.sc()
    executors = len(sc.statusTracker().getExecutorInfos()) - 1  # the driver is listed too
    if executors < 1:
        return spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return executors * sc.getConf().getSizeAsBytes("spark.executor.memory", "1g")


def zone_state_conf(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Settings for the state of the zone-demand stream over the generated tables.

    In memory, Spark's default, while the groups (estimated in one pass over
    pickup time, zone and fare) fit the executors' heaps; otherwise on disk,
    which is slower per group, but takes no heap."""
    raw = {METERED: testdata.raw_metered(spark, sf_dir), DISPATCH: testdata.raw_dispatch(spark, sf_dir)}
    trips = clean_stream(trips_stream([normalise_stream(df, feed) for feed, df in raw.items()]))
    group = F.xxhash64(F.date_trunc("hour", "pickup_datetime"), "PULocationID")
    groups = trips.agg(F.approx_count_distinct(group)).first()[0]
    return {} if groups * STATE_GROUP_BYTES <= executor_heap(spark) * STATE_HEAP_SHARE else dict(DISK_STATE_CONF)


def testdata_trip_stream(
    spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    lateness: str | None = ZONE_LATENESS,
) -> DataFrame:
    """One file stream per feed over the generated tables, normalised, each with its
    own watermark, and combined."""
    ev = testdata.table(spark, sf_dir, "events").schema
    li = testdata.table(spark, sf_dir, "lineitem").schema
    metered = feed_stream(
        spark, sf_dir, METERED, ev, glob="events.parquet", bind=testdata.metered_from_events,
        max_files_per_trigger=max_files_per_trigger,
    )
    dispatch = feed_stream(
        spark, sf_dir, DISPATCH, li, glob="lineitem.parquet", bind=testdata.dispatch_from_lineitem,
        max_files_per_trigger=max_files_per_trigger,
    )
    return trips_stream([metered, dispatch], lateness)


def replayed_trip_stream(
    spark: SparkSession, sf_dir: str, batches: int = 4, fmt: str = "parquet", lateness: str | None = ZONE_LATENESS,
    task_rows: int = REPLAY_TASK_ROWS,
) -> DataFrame:
    """The same trips, each feed replayed in event-time order in ``batches`` micro-batches.

    A micro-batch takes one file of a feed, or as many as keep each of them at
    ``task_rows`` rows: one task sorts and writes a file, so its memory does
    not grow with the feed."""
    work = new_work_dir(spark, "stream-replay")
    streams = []
    for feed, raw in ((METERED, testdata.raw_metered(spark, sf_dir)), (DISPATCH, testdata.raw_dispatch(spark, sf_dir))):
        trips = normalise_stream(raw, feed)
        n = trips.count()
        batch_rows = max(1, -(-n // batches))
        files = -(-batch_rows // task_rows)  # of a micro-batch
        write_replay(
            trips, f"{work}/{feed}", -(-batch_rows // files), fmt=fmt, num_partitions=max(batches, -(-n // task_rows))
        )
        streams.append(canonical_stream(spark, f"{work}/{feed}", fmt, max_files_per_trigger=files))
    return trips_stream(streams, lateness)


# kind -> (start function, shape of its result, reader of its sink table)
_KINDS = {
    "zone_demand": (
        sq.start_zone_demand,
        lambda t: sq.zone_demand_stream(t, None),
        lambda spark, out: read_latest(spark, out, ZONE_KEYS),
    ),
    "daily_stats": (
        sq.start_daily_stats,
        lambda t: running.daily_stats(clean_stream(t)),
        read_snapshot,
    ),
    "daily_stats_windowed": (
        sq.start_daily_stats_windowed,
        lambda t: running.daily_stats_windowed(clean_stream(t)),
        lambda spark, out: read_latest(spark, out, sq.DAY_KEYS),
    ),
    "payment_analysis": (
        sq.start_payment,
        lambda t: running.payment_analysis(clean_stream(t)),
        read_snapshot,
    ),
}


def run_to_end(
    spark: SparkSession, trips: DataFrame, kind: str, work_dir: str | None = None,
    lateness: str | None = ZONE_LATENESS, state_conf: dict[str, str] | None = None,
) -> tuple[DataFrame, object]:
    """Start one of ``zone_demand`` / ``daily_stats`` / ``daily_stats_windowed`` /
    ``payment_analysis`` with ``availableNow``, wait for it, and return (result table, finished query).

    Zone demand and windowed days set a watermark of ``lateness``; ``None`` takes those that
    ``trips`` carry (one per feed). ``state_conf``: settings of the state store, kept by the checkpoint."""
    if kind not in _KINDS:
        raise ValueError(f"unknown streaming aggregation {kind!r}")
    start, shape, reader = _KINDS[kind]
    work = work_dir or new_work_dir(spark, f"stream-{kind}")
    paths = sq.StreamPaths(checkpoint=f"{work}/checkpoint", output=f"{work}/output")
    extra = {"lateness": lateness} if kind in ("zone_demand", "daily_stats_windowed") else {}
    if kind == "zone_demand":
        extra["no_data_batches"] = False  # the run ends with its input: no eviction-only batch
    # A unique name: two runs of the same kind may be active in one session.
    extra["name"] = f"{kind}-{work.rstrip('/').rsplit('/', 1)[-1]}"
    with sq.start_conf(spark, state_conf or {}):
        q = start(trips, paths, sq.Trigger(available_now=True), **extra)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query {kind} failed: {q.exception()}")
    try:
        out = reader(spark, paths.output)
    except AnalysisException:  # no micro-batch had rows: empty result of the right shape
        out = spark.createDataFrame([], shape(trips).schema)
    return out, q

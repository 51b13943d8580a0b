"""Split a trip table into numbered slices of N rows for replay as a stream.

Rows are put in event-time order (default) or in a seeded shuffle, numbered
0..n-1 and cut into slices of ``rows_per_file``; every row is in exactly one
slice, including the last, shorter one.

The row numbers are computed without a single-partition window:

1. sort globally (range partitioning on the order key plus a unique tie
   column, so even a timestamp that holds a third of all rows is split over
   many range partitions);
2. tag each row with ``monotonically_increasing_id`` (partition index in the
   upper bits, position inside the partition in the lower 33 bits) and cut
   the lineage with a reliable ``checkpoint`` so the positions are fixed;
3. count rows per partition (one row per partition), turn the counts into
   offsets, and broadcast that table after checking its size (the partition
   count; beyond a million partitions it is joined without a broadcast);
4. row number = offset of the partition + position inside it.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridepulse.functions.rowtext import row_md5
from ridepulse.schema import REPLAY_ROWS_PER_FILE, REPLAY_SEED, TRIP_COLUMNS
from ridepulse.session import new_work_dir, work_root

_POS_BITS = 33
# The offsets table has one row (two longs) per partition; broadcast it up to this many rows.
_BROADCAST_MAX_PARTITIONS = 1_000_000
EVENT_TIME = "event_time"
SHUFFLE = "shuffle"


def replay_order(df: DataFrame, order: str = EVENT_TIME, seed: int = REPLAY_SEED) -> list[Column]:
    """Sort key: pickup time then every canonical column, or a seeded hash of the row.

    The hash depends only on the row's values, so the shuffle is the same for
    any partitioning of the input (unlike ``rand(seed)``).
    """
    cols = [c for c in TRIP_COLUMNS if c in df.columns] + [c for c in df.columns if c not in TRIP_COLUMNS]
    if order == EVENT_TIME:
        return [F.col(c).asc_nulls_first() for c in cols]
    if order == SHUFFLE:
        return [row_md5(df, cols, str(seed)).asc()] + [F.col(c).asc_nulls_first() for c in cols]
    raise ValueError(f"unknown replay order {order!r}")


def with_row_number(
    df: DataFrame, order: list[Column], name: str = "row_number", num_partitions: int | None = None
) -> DataFrame:
    """0-based global row number along ``order``, computed in parallel.

    ``num_partitions`` sets the number of range partitions of the sort
    (default: ``spark.sql.shuffle.partitions``). Adaptive execution can merge
    range partitions but not split them, so at scale size it to the data
    (about input bytes / 256 MB).
    """
    work_root(df.sparkSession)  # make sure a reliable checkpoint folder is set
    tie = "_replay_tie"
    pos = "_replay_pos"
    keyed = df.withColumn(tie, F.monotonically_increasing_id())
    keys = [*order, F.col(tie)]
    if num_partitions:
        ordered = keyed.repartitionByRange(int(num_partitions), *keys).sortWithinPartitions(*keys)
    else:
        ordered = keyed.orderBy(*keys)
    tagged = ordered.withColumn(pos, F.monotonically_increasing_id()).drop(tie).checkpoint(eager=True)
    part = F.shiftright(F.col(pos), _POS_BITS)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: a window over it is small and bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.col(pos).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # Size check before broadcasting: the partition count of the checkpointed data.
    if tagged.rdd.getNumPartitions() <= _BROADCAST_MAX_PARTITIONS:
        offsets = F.broadcast(offsets)
    return (
        tagged.join(offsets, part == F.col("_part"))
        .withColumn(name, F.col("_offset") + local)
        .drop("_part", "_offset", pos)
    )


def assign_slices(
    df: DataFrame,
    rows_per_file: int = REPLAY_ROWS_PER_FILE,
    order: str = EVENT_TIME,
    seed: int = REPLAY_SEED,
    num_partitions: int | None = None,
) -> DataFrame:
    """Every row with its ``slice`` number (slice k holds rows k*N .. k*N+N-1)."""
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be positive")
    numbered = with_row_number(df, replay_order(df, order, seed), "_rn", num_partitions)
    return numbered.withColumn("slice", F.floor(F.col("_rn") / F.lit(rows_per_file))).drop("_rn")


def write_replay(
    df: DataFrame,
    out_dir: str,
    rows_per_file: int = REPLAY_ROWS_PER_FILE,
    order: str = EVENT_TIME,
    seed: int = REPLAY_SEED,
    fmt: str = "parquet",
    staging_dir: str | None = None,
    num_partitions: int | None = None,
) -> int:
    """Write one file per slice into ``out_dir``, slices in ascending order.

    One write puts every slice into a file of its own in a staging folder; the
    files are then moved to ``out_dir`` with ascending modification times, by
    which a file stream takes them. The number of Spark jobs does not depend on
    the number of slices. A ``source`` column (the feed a trip came from) is
    written behind the canonical ones. Returns the number of slices written.

    One task sorts and writes all rows of a slice, so its memory grows with
    ``rows_per_file``; ``num_partitions`` (default: the session's shuffle
    partitions) deals the rows out in the global sort and the slices in the write.
    """
    spark = df.sparkSession
    staging = staging_dir or new_work_dir(spark, "replay-staging")
    cols = [c for c in [*TRIP_COLUMNS, "source"] if c in df.columns]
    sliced = assign_slices(df, rows_per_file, order, seed, num_partitions).select("slice", *cols)
    dealt = sliced.repartition(int(num_partitions), "slice") if num_partitions else sliced.repartition("slice")
    writer = dealt.write.mode("overwrite").partitionBy("slice")
    writer = writer.option("maxRecordsPerFile", 0)
    if fmt == "csv":
        writer.option("header", True).csv(staging)
    else:
        writer.parquet(staging)
    return _publish(spark, staging, out_dir)


def _publish(spark, staging: str, out_dir: str) -> int:
    """Move the files of ``staging/slice=k`` to ``out_dir``, in the order of k, each a millisecond younger."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(out_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(out_dir))
    start = max([int(time.time() * 1000), *(f.getModificationTime() + 1 for f in fs.listStatus(path(out_dir)))])
    slices = {}
    for folder in fs.listStatus(path(staging)):
        if folder.isDirectory() and folder.getPath().getName().startswith("slice="):
            slices[int(folder.getPath().getName().removeprefix("slice="))] = folder.getPath()
    for k, folder in sorted(slices.items()):
        (file,) = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        to = path(out_dir, f"slice-{k:09d}-{file.getName()}")
        if not fs.rename(file, to):
            raise OSError(f"cannot move {file.toString()} to {to.toString()}")
        fs.setTimes(to, start + k, -1)
    fs.delete(path(staging), True)
    return len(slices)

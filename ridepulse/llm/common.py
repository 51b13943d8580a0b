"""Helpers shared by the corpus operators."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import ridepulse
from ridepulse.session import new_work_dir, prepare

# Words are maximal runs of bytes other than these; ``bytes.split()`` splits at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
# Texts are handed to vectorised code in slices of about this many bytes. That code needs some 60 bytes for each
# of them, and the hashes' powers, kept by every Python worker, come to 32 bytes for each up to the next power of two.
SLICE_BYTES = 3 << 19
# Arrow batches of long rows are cut at about this many bytes. Of a batch an executor holds several copies outside
# its heap (vectors that double as they grow, the stream to the worker), for each of its cores.
BATCH_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Pin the session settings, and hand this package to the Python workers (once per application)."""
    prepare(spark)
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        home = Path(ridepulse.__file__).parent
        to = Path(tempfile.mkdtemp(prefix="ridepulse-")) / "ridepulse"
        sc.addPyFile(shutil.make_archive(str(to), "zip", home.parent, home.name))  # Spark takes its copy to the executors
        _SHIPPED.add(sc.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Cuts the lineage: a lost executor costs the files of no finished step, and
    an expensive step runs once however often its rows are read.
    """
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that start inside hand rows to Python in batches of about ``BATCH_BYTES`` (one row at least).

    Spark's own limits are 10,000 rows and 64 MB.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        col = batch.column(column)
        start, size = 0, 0
        for i in range(batch.num_rows):
            n = len(col[i].as_buffer() or b"") if col[i].is_valid else 0
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)

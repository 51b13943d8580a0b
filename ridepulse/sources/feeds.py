"""Scan raw monthly feed files whose column types drift between months.

Reading every file with one schema loses rows: a file whose column has
another physical type (``bigint`` one month, ``double`` the next) cannot be
decoded with the first file's schema, and with ``ignoreCorruptFiles`` it is
skipped without an error; ``mergeSchema`` refuses to merge the two types.

Here the files are grouped by their own schema (footer only, no data read),
each group is read with its schema, routed to its feed's normaliser (which
casts to the canonical types) and the groups are combined by name. The plan
has one union branch per distinct schema (usually two or three), not one per
file. Files that cannot be read or belong to no known feed are reported in a
``rejected`` table instead of being dropped silently.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ridepulse.operators.normalize import (
    detect_feed,
    missing_batch_columns,
    drop_incomplete,
    normalise_batch,
    normalise_stream,
    union_trips,
)

FILE_COL = "_file"

REJECTED_SCHEMA = StructType(
    [StructField("path", StringType(), False), StructField("reason", StringType(), False)]
)
GROUPS_SCHEMA = StructType(
    [
        StructField("path", StringType(), False),
        StructField("feed", StringType(), False),
        StructField("schema_id", IntegerType(), False),
    ]
)
SCHEMAS_SCHEMA = StructType(
    [
        StructField("schema_id", IntegerType(), False),
        StructField("feed", StringType(), False),
        StructField("files", IntegerType(), False),
        StructField("schema", StringType(), False),
    ]
)


@dataclass
class FeedScan:
    """Result of a raw-file scan."""

    trips: DataFrame  # canonical trips (batch or stream layout)
    groups: DataFrame  # path, feed, schema_id of every accepted file
    schemas: DataFrame  # schema_id, feed, files, schema (JSON): one row per distinct file schema
    rejected: DataFrame  # path, reason of every skipped file


def list_files(spark: SparkSession, paths: list[str], ignore_missing: bool = False) -> list[str]:
    """Data files behind paths / globs (listing only); ``ignore_missing`` passes over paths that do not exist."""
    reader = spark.read
    paths = list(paths)
    if ignore_missing:
        reader = reader.option("ignoreMissingFiles", True)
        paths = [p for p in paths if _exists(spark, p)]
        if not paths:
            return []
    return sorted(reader.format("binaryFile").load(paths).select("path").inputFiles())


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def file_inventory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Path, size and modification time of every data file, with folder totals.

    The ``binaryFile`` source is used for its metadata columns only; without
    ``content`` in the projection no file body is read.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return files.withColumn("folder", folder)


def folder_sizes(inventory: DataFrame) -> DataFrame:
    """Files and bytes per folder (the ``du`` of a listing)."""
    return inventory.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def suggest_partitions(
    df: DataFrame,
    target_bytes: int = 256 * 1024 * 1024,
    expansion: float = 3.0,
) -> int | None:
    """Partitions for a shuffle that moves whole rows of ``df`` (a global sort,
    a partitioned table write): about ``target_bytes`` of decompressed rows each.

    The size comes from the metadata of the input files (no data is read);
    ``expansion`` is the assumed ratio of in-memory rows to compressed Parquet.
    """
    files = df.inputFiles()
    if not files:
        return None
    total = file_inventory(df.sparkSession, files).agg(F.sum("bytes")).first()[0] or 0
    return max(1, math.ceil(total * expansion / target_bytes))


def _file_schema(spark: SparkSession, path: str) -> tuple[str, StructType | None, str | None]:
    try:
        return path, spark.read.parquet(path).schema, None
    except Exception as exc:  # unreadable footer, not Parquet, permission ...
        return path, None, f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"


def _parent(path: str) -> str:
    return path.rsplit("/", 1)[0] if "/" in path else ""


def _arrow_schemas(batches):
    """mapInPandas body: a short key of each file's footer schema, read with pyarrow."""
    import hashlib

    import pandas as pd
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        keys, errors = [], []
        for path in batch["path"]:
            try:
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as fh:
                    schema = pq.read_schema(fh).remove_metadata()
                text = schema.to_string(show_field_metadata=False, show_schema_metadata=False)
                keys.append(hashlib.sha1(text.encode()).hexdigest()[:16])
                errors.append(None)
            except Exception as exc:  # unreadable footer, not Parquet ...
                keys.append(None)
                errors.append(f"{type(exc).__name__}: {str(exc).splitlines()[0][:300] if str(exc) else ''}")
        yield pd.DataFrame({"path": batch["path"], "arrow_schema": keys, "error": errors})


def _distributed_probe(spark: SparkSession, files: list[str]) -> list[tuple[str, StructType | None, str | None]]:
    """Footers read by the executors; the driver reads one footer per distinct schema."""
    paths = spark.createDataFrame([(f,) for f in files], "path string")
    n = max(1, min(len(files) // 64 + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    probed = (
        paths.repartition(n)
        .mapInPandas(_arrow_schemas, "path string, arrow_schema string, error string")
        .collect()
    )
    by_key: dict[str, StructType | None] = {}
    errors: dict[str, str] = {}
    for row in probed:
        if row.arrow_schema is None:
            continue
        if row.arrow_schema not in by_key:
            _, schema, err = _file_schema(spark, row.path)
            by_key[row.arrow_schema] = schema
            if err:
                errors[row.arrow_schema] = err
    out = []
    for row in probed:
        if row.arrow_schema is None:
            out.append((row.path, None, row.error or "unreadable"))
        else:
            out.append((row.path, by_key[row.arrow_schema], errors.get(row.arrow_schema)))
    return out


def group_by_schema(
    spark: SparkSession, files: list[str], threads: int = 16, probe: str = "file"
) -> tuple[dict[tuple[str, str], list[str]], list[tuple[str, str]]]:
    """{(feed, schema json): [paths]} and [(path, reason)] of rejected files.

    ``probe="file"`` reads every footer (exact; driver threads, fine for
    thousands of files). ``probe="directory"`` reads one footer per folder and
    applies it to the folder's files, for folders written by one producer
    (e.g. one per month); a file that does not match its folder's schema then
    makes the read fail with an error - rows are never dropped silently.
    ``probe="distributed"`` reads every footer on the executors (pyarrow in a
    ``mapInPandas`` task, exact) and only one footer per distinct schema on
    the driver; it needs the file system to be reachable from Python workers.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    rejected: list[tuple[str, str]] = []
    if probe == "directory":
        by_dir: dict[str, list[str]] = {}
        for f in files:
            by_dir.setdefault(_parent(f), []).append(f)
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            probed = list(pool.map(lambda fs: (fs, _file_schema(spark, fs[0])), by_dir.values()))
        results = []
        for fs, (_, schema, err) in probed:
            results += [(f, schema, err) for f in fs]
    elif probe == "file":
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            results = list(pool.map(lambda p: _file_schema(spark, p), files))
    elif probe == "distributed":
        results = _distributed_probe(spark, files)
    else:
        raise ValueError(f"unknown probe {probe!r}")
    for path, schema, err in results:
        if schema is None:
            rejected.append((path, err or "unreadable"))
            continue
        feed = detect_feed(schema.fieldNames())
        if feed is None:
            rejected.append((path, "unknown feed: columns " + ",".join(schema.fieldNames()[:12])))
            continue
        groups.setdefault((feed, schema.json()), []).append(path)
    return groups, rejected


def scan_feeds(
    spark: SparkSession,
    paths: list[str],
    layout: str = "batch",
    with_file: bool = False,
    ignore_missing: bool = False,
    probe: str = "file",
    with_source: bool = False,
) -> FeedScan:
    """Canonical trips from raw files of both feeds, whatever their column types.

    ``with_source``: stream-layout trips name their feed too (batch-layout ones always do)."""
    files = list_files(spark, paths, ignore_missing)
    groups, rejected = group_by_schema(spark, files, probe=probe)
    frames = []
    accepted = []
    schemas = []
    extra = (FILE_COL,) if with_file else ()
    for schema_id, ((feed, schema_json), group_paths) in enumerate(sorted(groups.items())):
        schema = StructType.fromJson(json.loads(schema_json))
        if layout == "batch":
            lacking = missing_batch_columns(feed, schema.fieldNames())
            if lacking:
                rejected += [(p, f"{feed} file lacks columns {lacking}") for p in group_paths]
                continue
        reader = spark.read.schema(schema)
        if ignore_missing:
            reader = reader.option("ignoreMissingFiles", True)
        raw = reader.parquet(*group_paths)
        if with_file:
            raw = raw.withColumn(FILE_COL, F.col("_metadata.file_path"))
        if layout == "batch":
            out = normalise_batch(raw, feed, extra=extra)
        else:
            out = normalise_stream(raw, feed, extra=extra)
            if with_source:
                out = out.withColumn("source", F.lit(feed))
        frames.append(out)
        accepted += [(p, feed, schema_id) for p in group_paths]
        schemas.append((schema_id, feed, len(group_paths), schema_json))
    if not frames:
        raise ValueError(f"no readable trip files among {len(files)} file(s): {rejected[:3]}")
    trips = union_trips(frames)
    if layout != "batch":
        trips = drop_incomplete(trips)
    return FeedScan(
        trips=trips,
        groups=spark.createDataFrame(accepted, GROUPS_SCHEMA),
        schemas=spark.createDataFrame(schemas, SCHEMAS_SCHEMA),
        rejected=spark.createDataFrame(rejected, REJECTED_SCHEMA),
    )

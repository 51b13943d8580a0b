"""A manifest of raw files: what each one is, found out once.

``<folder>/files`` has a row per file seen (path, size, modification time,
schema key, reason if its footer cannot be read), ``<folder>/schemas`` a row
per distinct schema (key, feed, Spark schema, reason if it is of no feed or
lacks columns). A scan lists the paths, keeps the listing as a DataFrame,
joins it with the manifest and opens the footers of new or changed files
alone, on the executors. What comes to the driver is bounded by the number of
distinct schemas and of folders: a folder whose files share one schema is read
by its name, only files of mixed folders are named one by one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridepulse.operators.normalize import detect_feed, drop_incomplete, missing_batch_columns, normalise_batch, normalise_stream, union_trips
from ridepulse.sources.feeds import FILE_COL, FeedScan, _exists, file_inventory

FILES_SCHEMA = "path string, bytes long, modified timestamp, schema_key string, reason string"
SCHEMAS_SCHEMA = "schema_key string, feed string, schema string, reason string"
_IDENTITY = ["path", "bytes", "modified"]
_FILES_PER_TASK = 64


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A key of each file's schema, from its footer; the reason where there is none."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        keys, reasons = [], []
        for path in batch.column("path").to_pylist():
            try:
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as fh:
                    # the file's own schema, with nothing of what a writer says about it
                    text = "\n".join(f"{f.name}|{f.type}" for f in pq.read_schema(fh))
                keys.append(hashlib.sha256(text.encode()).hexdigest()[:32])
                reasons.append(None)
            except Exception as exc:  # an unreadable footer, no Parquet, a store that Python does not reach
                keys.append(None)
                reasons.append(f"{type(exc).__name__}: {(str(exc).splitlines() or [''])[0][:300]}")
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _IDENTITY), pa.array(keys, pa.string()), pa.array(reasons, pa.string())],
            [*_IDENTITY, "schema_key", "reason"],
        )


class FileManifest:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def files(self) -> DataFrame:
        """Every file seen, in each state (size, modification time) it was seen in."""
        return self._table("files", FILES_SCHEMA).dropDuplicates(_IDENTITY)

    def schemas(self) -> DataFrame:
        return self._table("schemas", SCHEMAS_SCHEMA).dropDuplicates(["schema_key"])

    def listing(self, paths: list[str], ignore_missing: bool = False) -> DataFrame:
        paths = [p for p in paths if _exists(self.spark, p)] if ignore_missing else list(paths)
        if not paths:
            return self.spark.createDataFrame([], "path string, bytes long, modified timestamp")
        return file_inventory(self.spark, paths).select(*_IDENTITY)

    def refresh(self, listing: DataFrame) -> int:
        """Enter the new and changed files of a listing; returns how many footers were opened."""
        new = listing.join(self.files().select(*_IDENTITY), _IDENTITY, "left_anti").persist()
        try:
            count = new.count()
            if not count:
                return 0
            tasks = min(-(-count // _FILES_PER_TASK), 10 * int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            new.repartition(tasks).mapInArrow(_footers, FILES_SCHEMA).write.mode("append").parquet(f"{self.folder}/files")
        finally:
            new.unpersist()
        unknown = self.files().where("schema_key IS NOT NULL").join(self.schemas(), "schema_key", "left_anti")
        examples = unknown.groupBy("schema_key").agg(F.max("path").alias("path")).collect()  # a row per new schema
        rows = []
        for key, path in examples:
            schema = self.spark.read.parquet(path).schema
            feed = detect_feed(schema.fieldNames())
            reason = None if feed else "unknown feed: columns " + ",".join(schema.fieldNames()[:12])
            lacking = missing_batch_columns(feed, schema.fieldNames()) if feed else []
            if lacking:
                reason = f"{feed} file lacks columns {lacking}"
            rows.append((key, feed, schema.json(), reason))
        if rows:
            self.spark.createDataFrame(rows, SCHEMAS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/schemas")
        return count

    def scan(
        self, paths: list[str], layout: str = "batch", with_file: bool = False, ignore_missing: bool = False, with_source: bool = False
    ) -> FeedScan:
        """Canonical trips of the files behind ``paths``, whatever their column types (see ``feeds.scan_feeds``)."""
        listing = self.listing(paths, ignore_missing)
        self.refresh(listing)
        files = self.files().withColumnRenamed("reason", "unread")
        known = listing.join(files, _IDENTITY).join(F.broadcast(self.schemas()), "schema_key", "left")
        lacks = F.lit(layout == "batch") | F.col("feed").isNull()  # the stream normaliser fills what a file lacks
        known = known.withColumn("refused", F.coalesce("unread", F.when(lacks, F.col("reason"))))
        known = known.withColumn("in_folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
        accepted = known.where("refused IS NULL")
        # a row per folder and schema
        per_folder = known.groupBy("in_folder").agg(
            F.count_distinct(F.coalesce("schema_key", F.lit("")), F.coalesce("refused", F.lit(""))).alias("kinds"),
            F.count(F.lit(1)).alias("files"),
            F.min("schema_key").alias("schema_key"),
            F.min("refused").alias("refused"),
        ).collect()
        whole = self._whole_folders({r.in_folder: r.files for r in per_folder if r.kinds == 1 and r.refused is None})
        mixed = [r.in_folder for r in per_folder if r.in_folder not in whole and not (r.kinds == 1 and r.refused)]
        to_read: dict[str, list[str]] = {}
        for r in per_folder:
            if r.in_folder in whole:
                to_read.setdefault(r.schema_key, []).append(r.in_folder)
        if mixed:
            for path, key in accepted.where(F.col("in_folder").isin(mixed)).select("path", "schema_key").toLocalIterator():
                to_read.setdefault(key, []).append(path)
        schemas = {r.schema_key: r for r in self.schemas().collect()}  # a row per distinct schema
        frames, ids = [], []
        for number, key in enumerate(sorted(to_read, key=lambda k: (schemas[k].feed, schemas[k].schema))):
            feed, schema = schemas[key].feed, schemas[key].schema
            raw = self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*sorted(to_read[key]))
            if with_file:
                raw = raw.withColumn(FILE_COL, F.col("_metadata.file_path"))
            extra = (FILE_COL,) if with_file else ()
            out = normalise_batch(raw, feed, extra=extra) if layout == "batch" else normalise_stream(raw, feed, extra=extra)
            frames.append(out.withColumn("source", F.lit(feed)) if with_source and layout != "batch" else out)
            ids.append((key, number))
        if not frames:
            raise ValueError(f"no readable trip files behind {paths}: {known.select('path', 'refused').take(3)}")
        trips = union_trips(frames)
        numbered = F.broadcast(self.spark.createDataFrame(ids, "schema_key string, schema_id int"))
        groups = accepted.join(numbered, "schema_key").select("path", "feed", "schema_id")
        counted = accepted.join(numbered, "schema_key").groupBy("schema_id", "feed", "schema").agg(F.count(F.lit(1)).cast("int").alias("files"))
        return FeedScan(
            trips=trips if layout == "batch" else drop_incomplete(trips),
            groups=groups,
            schemas=counted.select("schema_id", "feed", "files", "schema"),
            rejected=known.where("refused IS NOT NULL").select("path", F.col("refused").alias("reason")),
        )

    def _whole_folders(self, counts: dict[str, int]) -> set[str]:
        """Of folders with as many listed files, those that hold no other file and lie in none of the others."""
        if not counts:
            return set()
        there = file_inventory(self.spark, sorted(counts)).groupBy("folder").agg(F.count(F.lit(1)).alias("files")).collect()
        found = {r.folder: r.files for r in there}
        above = {f[:i] for f in found for i, c in enumerate(f) if c == "/"}  # every folder above one with files
        return {f for f, n in counts.items() if found.get(f) == n} - above

"""Batch summaries of a stored trip table, kept per (source, month) and merged on read.

All thirteen batch results come from sums, counts, least and greatest values
(``one_pass.summary_sets``), so the aggregate of the whole table is the sum of
those of its partitions. ``update`` lists the table's files, compares what it
finds with a fingerprint stored for each partition (paths, sizes and
modification times of its files) and aggregates only the partitions that are
new or changed, in one scan; ``sets`` adds the stored aggregates up, for all
of the table or for some feeds and months, without reading a trip.

Each update is a folder of its own (``parts``: the partitions it holds, with
their fingerprints, NULL for one that is gone; ``sets``: their aggregates)
entered in a commit log. A partition counts as its newest folder has it, so a
reader sees one version whole. An update fails to commit if another one came
first, and then starts anew. After ``fold_after`` folders an update also takes
over what is still current in them, and they go.

A fingerprint is taken before the files are read: files that change in between
have another one at the next update, which reads them again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.plans import one_pass
from ridepulse.schema import TRIPS
from ridepulse.sources.feeds import file_inventory
from ridepulse.sources.trip_table import MONTH_COL
from ridepulse.streaming.commits import KEEP_VERSIONS, CommitLog, Folder, Version

PART = "_part"
PARTS_SCHEMA = f"{PART} string, fingerprint string, batch long"
FOLD_AFTER = 16
# How Spark names the folder of rows without a month.
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_PART_PATTERN = rf"(source=[^/]+/{MONTH_COL}=[^/]+)$"


class _Overtaken(Exception):
    """Another update was committed since the version this one started from."""


@dataclass(frozen=True)
class Update:
    version: int
    read: list[str]  # partitions that were aggregated
    gone: list[str]  # partitions that the table no longer has


def _month(part: str) -> str | None:
    value = part.rpartition("=")[2]
    return None if value == _NO_MONTH else value


def _source(part: str) -> str:
    return part.partition("/")[0].removeprefix("source=")


class StoredSummaries:
    def __init__(self, spark: SparkSession, folder: str, fold_after: int = FOLD_AFTER, keep: int = KEEP_VERSIONS):
        self.spark, self.fold_after, self.keep = spark, fold_after, keep
        self.log = CommitLog(spark, folder)

    def update(self, table: str) -> Update:
        """Bring the summaries up to the files that ``table`` has now."""
        while True:
            version = self.log.newest()
            known = self._parts(version)
            there = self._fingerprints(table)
            changed = sorted(p for p, print_ in there.items() if p not in known or known[p][0] != print_)
            gone = sorted(p for p in known if p not in there)
            if not changed and not gone:
                return Update(version.number, [], [])
            try:
                number = self._write(version, known, table, {p: there[p] for p in changed}, gone)
            except _Overtaken:
                continue
            self.log.vacuum(self.keep)
            return Update(number, changed, gone)

    def _write(self, version: Version, known: dict, table: str, changed: dict[str, str], gone: list[str]) -> int:
        fold = len(version.live) >= self.fold_after
        folder = self.log.new_folder(version.number + 1, folded=fold)
        heads = dict(changed)
        frames = [one_pass.summary_sets(self.trips(table, list(changed)), by=[PART])] if changed else []
        if fold:
            kept = {p: known[p] for p in known if p not in changed and p not in gone}
            heads |= {p: print_ for p, (print_, _) in kept.items()}
            frames += self._frames(kept)
        else:
            heads |= dict.fromkeys(gone)
        for n, frame in enumerate(frames):
            frame.write.mode("append" if n else "errorifexists").parquet(f"{self.log.path(folder)}/sets")
        rows = [(p, print_, folder.batch) for p, print_ in sorted(heads.items())]
        self.spark.createDataFrame(rows, PARTS_SCHEMA).coalesce(1).write.parquet(f"{self.log.path(folder)}/parts")

        def replaced(now: Version) -> list[Folder]:
            if now.number != version.number:
                raise _Overtaken
            return list(now.live) if fold else []

        return self.log.commit([folder], replaced).number

    def _fingerprints(self, table: str) -> dict[str, str]:
        """{partition: fingerprint of its files}; a row per (source, month) comes to the driver."""
        columns = ",".join(sorted(one_pass.summary_sets(self._no_trips()).columns))  # other measures: read anew
        file = F.xxhash64(F.lit(columns), "path", "bytes", F.unix_micros("modified")).cast("decimal(38,0)")
        parts = file_inventory(self.spark, [table]).groupBy(F.regexp_extract("folder", _PART_PATTERN, 1).alias(PART))
        rows = parts.agg(F.count(F.lit(1)).alias("files"), F.sum(file).alias("hash")).collect()
        if any(not r[PART] for r in rows):
            raise ValueError(f"{table} holds files outside of source=.../{MONTH_COL}=... folders")
        return {r[PART]: f"{r.files}-{r.hash}" for r in rows}

    def _no_trips(self) -> DataFrame:
        return self.spark.createDataFrame([], TRIPS).withColumn("source", F.lit(None).cast("string"))

    def trips(self, table: str, parts: list[str]) -> DataFrame:
        """The rows of some partitions, each with its partition's name; no other file is listed or read."""
        paths = [f"{table.rstrip('/')}/{p}" for p in parts]
        rows = self.spark.read.option("basePath", table).parquet(*paths)
        month = F.coalesce(F.col(MONTH_COL).cast("string"), F.lit(_NO_MONTH))
        return rows.withColumn(PART, F.concat(F.lit("source="), "source", F.lit(f"/{MONTH_COL}="), month)).drop(MONTH_COL)

    def _parts(self, version: Version) -> dict[str, tuple[str, Folder]]:
        """{partition: (fingerprint, the folder that has it)}; bounded by partitions x live folders."""
        if not version.live:
            return {}
        folders = {f.batch: f for f in version.live}
        heads = self.spark.read.schema(PARTS_SCHEMA).parquet(*(f"{self.log.path(f)}/parts" for f in version.live))
        newest = heads.groupBy(PART).agg(F.max_by(F.struct("fingerprint", "batch"), "batch").alias("at")).collect()
        return {r[PART]: (r["at"].fingerprint, folders[r["at"].batch]) for r in newest if r["at"].fingerprint is not None}

    def _frames(self, parts: dict[str, tuple[str, Folder]]) -> list[DataFrame]:
        """The stored aggregates of some partitions, a frame per folder."""
        by_folder: dict[Folder, list[str]] = {}
        for part, (_, folder) in sorted(parts.items()):
            by_folder.setdefault(folder, []).append(part)
        return [
            self.spark.read.parquet(f"{self.log.path(folder)}/sets").where(F.col(PART).isin(names))
            for folder, names in by_folder.items()
        ]

    def sets(
        self, sources: list[str] | None = None, months: tuple[str, str] | None = None, version: int | None = None
    ) -> DataFrame:
        """The aggregate of ``one_pass.summary_sets`` over all trips, or those of some feeds and an inclusive
        month range, as of the newest version or an older one that is kept."""
        parts = self._parts(self.log.version(version))
        if sources:
            parts = {p: at for p, at in parts.items() if _source(p) in sources}
        if months:
            parts = {p: at for p, at in parts.items() if _month(p) is not None and months[0] <= _month(p) <= months[1]}
        frames = self._frames(parts) or [one_pass.summary_sets(self._no_trips().withColumn(PART, F.lit("")), by=[PART])]
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.unionByName(frame)
        return one_pass.merge(rows, [PART])

    def results(self, **which) -> dict[str, DataFrame]:
        """Every batch result (see ``one_pass.results_from_sets``)."""
        return one_pass.results_from_sets(self.sets(**which))

"""Sinks for streaming aggregates, written through ``foreachBatch``.

File sinks accept append mode only, so the two result shapes are kept as
tables under a commit log (``ridepulse.streaming.commits``):

* update mode (``KeyedUpdateSink``): each micro-batch adds a folder with the
  rows it changed; the current table is, per key, the row of the highest
  batch id. When ``fold_after`` folders are live, the sink folds them into
  one, so neither readers nor storage pay for the stream's whole history.
* complete mode (``SnapshotSink``): each micro-batch adds a folder with the
  whole result and removes the one before.

A batch writes its rows first and then one small commit file. Until that file
is there the rows are in no version; a retried batch writes a new folder and
its commit takes the place of the earlier one, so a restart from the
checkpoint loses and doubles nothing. Readers read one version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridepulse.streaming.commits import KEEP_VERSIONS, CommitLog, Folder, NothingCommitted, Version

BATCH_COL = "batch_id"
FOLD_AFTER = 64


def _with_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))


class KeyedUpdateSink:
    """foreachBatch writer for update-mode results; with ``keys`` it folds ``fold_after`` live folders into one."""

    def __init__(self, out_dir: str, keys: list[str] | None = None, fold_after: int = FOLD_AFTER, keep: int = KEEP_VERSIONS):
        self.out_dir, self.keys, self.fold_after, self.keep = out_dir, keys, fold_after, keep

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        log = CommitLog(df.sparkSession, self.out_dir)
        folder = log.new_folder(batch_id)
        _with_batch(df, batch_id).write.parquet(log.path(folder))
        version = log.commit([folder], lambda now: [f for f in now.live if f.batch == batch_id and not f.folded])
        if self.keys and len(version.live) >= self.fold_after:
            _fold(log, version, list(version.live), self.keys)
            log.vacuum(self.keep)


class SnapshotSink:
    """foreachBatch writer for complete-mode results (small key spaces)."""

    def __init__(self, out_dir: str, keep: int = KEEP_VERSIONS):
        self.out_dir, self.keep = out_dir, keep

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        log = CommitLog(df.sparkSession, self.out_dir)
        folder = log.new_folder(batch_id)
        _with_batch(df, batch_id).write.parquet(log.path(folder))
        version = log.commit([folder], lambda now: list(now.live))
        if version.number % max(1, self.keep // 2) == 0:
            log.vacuum(self.keep)


def _rows(log: CommitLog, folders: list[Folder]) -> DataFrame:
    return log.spark.read.parquet(*(log.path(f) for f in folders))


def _latest_of(df: DataFrame, keys: list[str], with_batch: bool = False) -> DataFrame:
    """Per key, the values of the highest batch id.

    ``max_by`` is an aggregate with a partial stage, so a key updated in
    every batch costs one partial row per task, not one task per key.
    """
    values = [c for c in df.columns if c not in keys and c != BATCH_COL]
    packed = F.struct(*[F.col(c).alias(c) for c in values])
    latest = df.groupBy(*keys).agg(F.max_by(packed, F.col(BATCH_COL)).alias("_v"), F.max(BATCH_COL).alias(BATCH_COL))
    out = latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values], BATCH_COL)
    return out if with_batch else out.drop(BATCH_COL)


def _fold(log: CommitLog, version: Version, folders: list[Folder], keys: list[str]) -> Version | None:
    """One folder in place of several; None if one of them went meanwhile (another fold was first)."""
    folded = log.new_folder(max(f.batch for f in folders), folded=True)
    _latest_of(_rows(log, folders), keys, with_batch=True).write.parquet(log.path(folded))
    return log.commit([folded], lambda now: folders, needs=folders)


def read_updates(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every row kept by an update-mode sink, with the batch it came from."""
    log = CommitLog(spark, out_dir)
    return _rows(log, list(log.version().live))


def read_latest(spark: SparkSession, out_dir: str, keys: list[str], version: int | None = None) -> DataFrame:
    """Table of an update-mode sink, as of one version (the newest at the time of the call)."""
    log = CommitLog(spark, out_dir)
    return _latest_of(_rows(log, list(log.version(version).live)), keys)


def compact_updates(spark: SparkSession, out_dir: str, keys: list[str], final: bool = False) -> int | None:
    """Fold the live folders of an update-mode sink into one.

    The newest batch is left out unless ``final`` (the query is stopped): a
    retry of it would have to take its place. Returns the batch id the folded
    folder covers (None when there is nothing yet).
    """
    log = CommitLog(spark, out_dir)
    try:
        version = log.version()
    except NothingCommitted:
        return None
    folders = [f for f in version.live if final or f.batch < version.batch()]
    if len(folders) > 1:
        _fold(log, version, folders, keys)
        log.vacuum()
    return folders[-1].batch if folders else None


def read_snapshot(spark: SparkSession, out_dir: str, version: int | None = None) -> DataFrame:
    """Table of a complete-mode sink, as of one version (the newest at the time of the call)."""
    log = CommitLog(spark, out_dir)
    return _rows(log, list(log.version(version).live)).drop(BATCH_COL)

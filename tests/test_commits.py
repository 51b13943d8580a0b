"""Tables of streaming results under a commit log: versions, retries, folding, vacuum, two writers."""

from __future__ import annotations

import os
import threading

import pytest

from ridepulse.streaming import sinks
from ridepulse.streaming.commits import CommitLog, NothingCommitted
from ridepulse.streaming.sinks import KeyedUpdateSink, SnapshotSink, compact_updates, read_latest, read_snapshot


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v long").coalesce(1)


def rows(df):
    return sorted(map(tuple, df.collect()))


def folders(out):
    return sorted(d for d in os.listdir(out) if d.startswith(("data-", "fold-")))


def test_a_reader_keeps_its_version(spark, tmp_dir):
    """Two batches (and a fold) land between reading the version and the rows."""
    sink, snap = KeyedUpdateSink(f"{tmp_dir}/u", ["k"]), SnapshotSink(f"{tmp_dir}/s")
    for out in (sink, snap):
        out(batch(spark, (1, 10), (2, 20)), 0)
    latest, whole = read_latest(spark, f"{tmp_dir}/u", ["k"]), read_snapshot(spark, f"{tmp_dir}/s")
    for b in (1, 2):
        sink(batch(spark, (1, 10 + b)), b)
        snap(batch(spark, (1, 10 + b), (2, 20), (3, b)), b)
    compact_updates(spark, f"{tmp_dir}/u", ["k"], final=True)
    assert rows(latest) == rows(whole) == [(1, 10), (2, 20)]
    assert rows(read_latest(spark, f"{tmp_dir}/u", ["k"])) == [(1, 12), (2, 20)]
    assert rows(read_latest(spark, f"{tmp_dir}/u", ["k"], version=1)) == [(1, 11), (2, 20)]
    assert rows(read_snapshot(spark, f"{tmp_dir}/s")) == [(1, 12), (2, 20), (3, 2)]


def test_retried_batches(spark, tmp_dir, monkeypatch):
    """A batch written twice counts once; rows of an attempt that did not commit are in no version; a retry after a fold loses nothing."""
    out = f"{tmp_dir}/u"
    sink = KeyedUpdateSink(out, ["k"], fold_after=3)
    sink(batch(spark, (1, 1), (2, 2)), 0)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sink(batch(spark, (9, 9)), 1)
    assert rows(read_latest(spark, out, ["k"])) == [(1, 1), (2, 2)]
    for _ in range(2):
        sink(batch(spark, (2, 3)), 1)
    assert len(CommitLog(spark, out).version().live) == 2
    for _ in range(2):
        sink(batch(spark, (3, 4)), 2)  # the third live folder: folded, then the batch once more
        assert rows(read_latest(spark, out, ["k"])) == [(1, 1), (2, 3), (3, 4)]


def test_folders_are_bounded(spark, tmp_dir):
    keyed, snap = KeyedUpdateSink(f"{tmp_dir}/u", ["k"], fold_after=4, keep=3), SnapshotSink(f"{tmp_dir}/s", keep=3)
    for b in range(40):
        keyed(batch(spark, (b % 7, b)), b)
        snap(batch(spark, (0, b)), b)
        assert len(folders(f"{tmp_dir}/u")) <= 12 and len(folders(f"{tmp_dir}/s")) <= 8
        assert len(os.listdir(f"{tmp_dir}/s/_commits")) < 50  # with their checksum files
    assert rows(read_latest(spark, f"{tmp_dir}/u", ["k"])) == sorted((b % 7, b) for b in range(33, 40))
    assert rows(read_snapshot(spark, f"{tmp_dir}/s")) == [(0, 39)]


def test_two_writers(spark, tmp_dir):
    """Every commit gets a version of its own, whoever else commits."""
    logs = [CommitLog(spark, tmp_dir) for _ in range(4)]

    def write(log, first):
        for b in range(first, first + 6):
            log.commit([log.new_folder(b)])

    threads = [threading.Thread(target=write, args=(log, 100 * i)) for i, log in enumerate(logs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert logs[0].numbers() == list(range(24))
    assert sorted(f.batch for f in logs[0].version().live) == sorted(100 * i + b for i in range(4) for b in range(6))


def test_the_slower_fold_gives_way(spark, tmp_dir):
    sink = KeyedUpdateSink(tmp_dir, ["k"])
    for b in range(3):
        sink(batch(spark, (b, b)), b)
    log = CommitLog(spark, tmp_dir)
    seen = log.version()
    assert sinks._fold(log, seen, list(seen.live), ["k"]) is not None
    assert sinks._fold(log, seen, list(seen.live), ["k"]) is None
    assert rows(read_latest(spark, tmp_dir, ["k"])) == [(0, 0), (1, 1), (2, 2)]


def test_nothing_yet(spark, tmp_dir):
    with pytest.raises(NothingCommitted):
        read_snapshot(spark, f"{tmp_dir}/none")
    assert CommitLog(spark, f"{tmp_dir}/none").vacuum() == 0

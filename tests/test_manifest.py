"""The manifest of raw files: same rows as a scan without one, old footers stay closed."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL
from helpers import as_set

from ridepulse.plans import batch_job, catalog
from ridepulse.sources import manifest as mf
from ridepulse.sources import testdata
from ridepulse.sources.feeds import scan_feeds
from ridepulse.sources.manifest import FileManifest


@pytest.fixture()
def raw(spark, tmp_dir):
    work = catalog._drifted_files(spark, SF_SMALL).removeprefix("file:")
    odd = f"{work}/raw/d"
    spark.range(3).coalesce(1).write.parquet(f"{odd}/x")
    with open(f"{odd}/broken.parquet", "w") as f:
        f.write("no footer")
    return f"{work}/raw"


def globs(raw):
    return [f"{raw}/*/*.parquet", f"{raw}/*/x/*.parquet"]


def named(df, *cols):
    """Rows by path, however its scheme is written."""
    return sorted((r.path.replace("file:///", "file:/"), *(r[c] for c in cols)) for r in df.collect())


def test_same_rows_and_reports_as_a_plain_scan(spark, raw, tmp_dir):
    for layout in ("batch", "stream"):
        plain = scan_feeds(spark, globs(raw), layout=layout)
        known = FileManifest(spark, f"{tmp_dir}/m").scan(globs(raw), layout=layout)
        assert as_set(known.trips) == as_set(plain.trips) and known.trips.columns == plain.trips.columns
        assert named(known.groups, "feed") == named(plain.groups, "feed")
        assert named(known.rejected) == named(plain.rejected) and known.rejected.count() == 2
        reasons = " ".join(r.reason for r in known.rejected.collect())
        assert "unknown feed" in reasons and "broken" not in reasons
        assert sum(r.files for r in known.schemas.collect()) == known.groups.count()


def test_only_new_and_changed_footers_are_opened(spark, raw, tmp_dir):
    manifest = FileManifest(spark, f"{tmp_dir}/m")
    first = manifest.refresh(manifest.listing(globs(raw)))
    assert first == manifest.listing(globs(raw)).count() > 4
    assert manifest.refresh(manifest.listing(globs(raw))) == 0
    testdata.raw_metered(spark, SF_SMALL).limit(5).coalesce(1).write.parquet(f"{raw}/e")
    assert manifest.refresh(manifest.listing(globs(raw))) == 1
    (name,) = [n for n in os.listdir(f"{raw}/e") if n.endswith(".parquet")]
    os.utime(f"{raw}/e/{name}", (10**9, 10**9))
    assert manifest.refresh(manifest.listing(globs(raw))) == 1  # another state of the file
    plain = scan_feeds(spark, globs(raw))
    assert as_set(manifest.scan(globs(raw)).trips) == as_set(plain.trips)


def test_folders_are_read_by_name_unless_mixed(spark, raw, tmp_dir, monkeypatch):
    """Files of a and b share a schema each; c holds two kinds; a file outside the listing is not read."""
    seen = []
    whole = FileManifest._whole_folders
    monkeypatch.setattr(FileManifest, "_whole_folders", lambda self, counts: seen.append(whole(self, counts)) or seen[-1])
    manifest = FileManifest(spark, f"{tmp_dir}/m")
    manifest.scan(globs(raw))
    assert {f.rsplit("/", 1)[1] for f in seen[-1]} == {"a", "b"}
    some = sorted(n for n in os.listdir(f"{raw}/a") if n.endswith(".parquet"))
    testdata.raw_metered(spark, SF_SMALL).limit(5).coalesce(1).write.mode("append").parquet(f"{raw}/a")
    got = manifest.scan([f"{raw}/a/{n}" for n in some] + [f"{raw}/b"])
    assert {f.rsplit("/", 1)[1] for f in seen[-1]} == {"b"}
    assert as_set(got.trips) == as_set(scan_feeds(spark, [f"{raw}/a/{n}" for n in some] + [f"{raw}/b"]).trips)


def test_nested_folders_are_not_read_twice(spark, tmp_dir):
    metered = testdata.raw_metered(spark, SF_SMALL)
    metered.limit(10).coalesce(1).write.parquet(f"{tmp_dir}/raw/a")
    metered.limit(7).coalesce(1).write.parquet(f"{tmp_dir}/raw/a/b")
    scan = FileManifest(spark, f"{tmp_dir}/m").scan([f"{tmp_dir}/raw/a/*.parquet", f"{tmp_dir}/raw/a/b/*.parquet"])
    assert scan.trips.count() == 17


def test_batch_job_with_a_manifest(spark, raw, tmp_dir):
    with pytest.raises(ValueError, match="cannot be used"):
        batch_job.load_trips(spark, raw=globs(raw), manifest=f"{tmp_dir}/m")
    rejected: list = []
    trips = batch_job.load_trips(spark, raw=globs(raw), allow_rejected=True, rejected=rejected, manifest=f"{tmp_dir}/m")
    assert len(rejected) == 2 and as_set(trips) == as_set(catalog.trips_union(spark, SF_SMALL))


def test_no_files(spark, tmp_dir):
    with pytest.raises(ValueError, match="no readable trip files"):
        FileManifest(spark, f"{tmp_dir}/m").scan([f"{tmp_dir}/none"], ignore_missing=True)
    assert mf.FileManifest(spark, f"{tmp_dir}/m").files().count() == 0

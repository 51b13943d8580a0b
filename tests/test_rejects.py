"""Damaged lines of CSV streams: kept with file, reason and text; every other line is counted, by every query."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from helpers import as_set
from pyspark.sql import functions as F

from ridepulse.operators import running
from ridepulse.operators.clean import clean_stream
from ridepulse.plans import catalog
from ridepulse.schema import TRIP_COLUMNS
from ridepulse.streaming import job as stream_job
from ridepulse.streaming.queries import StreamPaths, Trigger
from ridepulse.streaming.rejects import FIELD_COUNT, csv_lines, good_trips, read_rejects, start_rejects
from ridepulse.streaming.runs import ZONE_KEYS
from ridepulse.streaming.sinks import read_latest, read_snapshot

GOOD = "2023-01-05T10:00:00.000Z,2023-01-05T10:20:00.000Z,1.0,1.5,1,2,1,10.0,1.0,11.0"
BAD = {
    GOOD.replace("2023-01-05T10:00:00.000Z", "yesterday"): "pickup_datetime",
    GOOD.replace(",1.0,11.0", ",one,11.0"): "tip_amount",
    GOOD.replace(",1,2,1,", ",1.5,x,1,"): "PULocationID,DOLocationID",
    "2023-01-05T10:00:00.000Z,2023-01-05T10:20": FIELD_COUNT,
    GOOD + ",12": FIELD_COUNT,
    '"' + GOOD: FIELD_COUNT,
}


def write(folder, name, lines, header=TRIP_COLUMNS):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n")


def test_reasons_texts_and_empty_values(spark, tmp_path):
    empty = GOOD.replace(",1.0,11.0", ",,11.0")  # no tip: a good line
    write(tmp_path / "in", "a.csv", [GOOD, empty, *list(BAD)[:5], GOOD])
    write(tmp_path / "in", "b.csv", [list(BAD)[5]])  # a quote that never ends
    lines = csv_lines(spark, f"{tmp_path}/in")
    q = start_rejects(lines, StreamPaths(f"{tmp_path}/c", f"{tmp_path}/out"), Trigger(available_now=True), "reasons")
    q.awaitTermination()
    rows = read_rejects(spark, f"{tmp_path}/out").collect()
    assert sorted(r.reason for r in rows) == sorted(BAD.values())
    texts = {r.record for r in rows}
    assert set(list(BAD)[:2]) <= texts and set(list(BAD)[3:5]) <= texts
    assert all(r.file.endswith("b.csv") == r.record.startswith('"') for r in rows)
    out = good_trips(lines).writeStream.format("memory").queryName("good_lines").trigger(availableNow=True).start()
    out.awaitTermination()
    got = spark.sql("SELECT * FROM good_lines").collect()
    assert len(got) == 3 and sum(r.tip_amount is None for r in got) == 1
    assert read_rejects(spark, f"{tmp_path}/none").count() == 0


def test_job_counts_good_lines_alone_and_restarts(spark, tmp_path):
    trips = catalog.trips_stream_norm(spark, SF_SMALL)
    trips.coalesce(1).write.option("header", True).csv(f"{tmp_path}/in")
    write(tmp_path / "in", "bad1.csv", list(BAD)[:4])

    def run():
        started = stream_job.start_all(spark, f"{tmp_path}/in", f"{tmp_path}/w", fmt="csv", available_now=True,
                                       lateness="100 years", rejects=True)
        try:
            started.await_all()
        finally:
            started.stop_all()
        cleaned = clean_stream(trips)
        # a damaged tip is no matter to zone demand, but its line is damaged there too
        assert as_set(read_latest(spark, f"{tmp_path}/w/zone_demand/output", ZONE_KEYS)) == as_set(running.zone_demand(cleaned))
        assert as_set(read_snapshot(spark, f"{tmp_path}/w/payment_analysis/output")) == as_set(running.payment_analysis(cleaned))
        return read_rejects(spark, f"{tmp_path}/w/rejects/output")

    assert run().count() == 4
    write(tmp_path / "in", "bad2.csv", list(BAD)[:3])
    again = run()
    assert again.count() == 7 and again.where(F.col("file").endswith("bad2.csv")).count() == 3


def test_feeds_with_damaged_sources_and_other_formats(spark, tmp_path):
    cols = [*TRIP_COLUMNS, "source"]
    write(tmp_path / "in", "a.csv", [f"{GOOD},yellow_taxi", f"{GOOD},hvfhv", GOOD], cols)  # the last one lacks its feed
    started = stream_job.start_all(spark, f"{tmp_path}/in", f"{tmp_path}/w", fmt="csv", available_now=True,
                                   feeds=["yellow_taxi", "hvfhv"], rejects=True)
    try:
        started.await_all()
    finally:
        started.stop_all()
    assert [r.reason for r in read_rejects(spark, f"{tmp_path}/w/rejects/output").collect()] == [FIELD_COUNT]
    assert read_snapshot(spark, f"{tmp_path}/w/payment_analysis/output").first().trip_count == 2
    with pytest.raises(ValueError, match="CSV"):
        stream_job.start_all(spark, f"{tmp_path}/in", f"{tmp_path}/w2", rejects=True)


def test_a_header_that_does_not_fit_fails(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [GOOD], [*TRIP_COLUMNS[1:], TRIP_COLUMNS[0]])
    q = start_rejects(csv_lines(spark, f"{tmp_path}/in"), StreamPaths(f"{tmp_path}/c", f"{tmp_path}/out"), Trigger(available_now=True), "header")
    with pytest.raises(Exception, match="(?i)header"):
        q.awaitTermination()

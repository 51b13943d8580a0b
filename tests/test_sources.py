"""Drift-safe scan, feed routing, CSV by name, result files (FIXTURES G-DRIFT, G-CSV)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ridepulse.schema import TRIP_COLUMNS, TRIPS
from ridepulse.sources.feeds import scan_feeds
from ridepulse.sources.results import (
    MissingColumns,
    read_result_csv,
    read_trip_csv,
    read_trip_csv_by_name,
    require_columns,
    write_result,
)

T0 = dt.datetime(2023, 1, 5, 10, 0, 0)


def _metered_rows(spark, pcs, pc_type):
    rows = [
        (T0, T0 + dt.timedelta(minutes=20), pc, 1.5, 10, 20, 1, 12.5, 2.0, 14.5) for pc in pcs
    ]
    schema = (
        f"tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count {pc_type}, "
        "trip_distance double, PULocationID bigint, DOLocationID bigint, payment_type bigint, "
        "fare_amount double, tip_amount double, total_amount double"
    )
    return spark.createDataFrame(rows, schema)


def test_drift_keeps_every_row(spark, tmp_dir):
    _metered_rows(spark, [1, 2, 3], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/m1")
    _metered_rows(spark, [4.0, 5.0], "double").coalesce(1).write.parquet(f"{tmp_dir}/m2")
    scan = scan_feeds(spark, [f"{tmp_dir}/m1", f"{tmp_dir}/m2"])
    got = sorted(r.passenger_count for r in scan.trips.collect())
    assert got == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert scan.rejected.count() == 0
    assert scan.schemas.count() == 2


def test_unknown_and_unreadable_files_are_reported(spark, tmp_dir):
    _metered_rows(spark, [1], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/m")
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(f"{tmp_dir}/other")
    os.makedirs(f"{tmp_dir}/bad", exist_ok=True)
    with open(f"{tmp_dir}/bad/broken.parquet", "wb") as fh:
        fh.write(b"not a parquet file at all")
    scan = scan_feeds(spark, [f"{tmp_dir}/m", f"{tmp_dir}/other", f"{tmp_dir}/bad"])
    assert scan.trips.count() == 1
    reasons = {os.path.basename(r.path): r.reason for r in scan.rejected.collect()}
    assert any("unknown feed" in v for v in reasons.values())
    assert "broken.parquet" in reasons


def test_both_feeds_and_file_column(spark, tmp_dir):
    _metered_rows(spark, [1, 2], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/yellow")
    spark.createDataFrame(
        [(T0, T0 + dt.timedelta(minutes=9), 3.0, 5, 6, 20.0, 1.0, 15.0)],
        "pickup_datetime timestamp, dropoff_datetime timestamp, trip_miles double, PULocationID long, "
        "DOLocationID long, base_passenger_fare double, tips double, driver_pay double",
    ).coalesce(1).write.parquet(f"{tmp_dir}/fhv")
    scan = scan_feeds(spark, [f"{tmp_dir}/yellow", f"{tmp_dir}/fhv"], with_file=True)
    by_src = {r.source: r["count"] for r in scan.trips.groupBy("source").count().collect()}
    assert by_src == {"yellow_taxi": 2, "hvfhv": 1}
    d = scan.trips.filter(F.col("source") == "hvfhv").first()
    assert d.passenger_count is None and d.payment_type is None and d.total_amount == 15.0
    assert "fhv" in d._file
    s = scan_feeds(spark, [f"{tmp_dir}/fhv"], layout="stream").trips.first()
    assert (s.passenger_count, s.payment_type, s.total_amount) == (1.0, 1, 21.0)


DISPATCH_HEADER = (
    "pickup_datetime,dropoff_datetime,trip_distance,PULocationID,DOLocationID,tip_amount,fare_amount,"
    "passenger_count,payment_type,total_amount"
)
DISPATCH_ROW = "2023-01-05 10:00:00,2023-01-05 10:20:00,2.5,132,48,3.0,25.95,1,1,28.95"


def test_csv_read_by_name(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/part.csv", "w") as fh:
        fh.write(DISPATCH_HEADER + "\n" + DISPATCH_ROW + "\n")
    r = read_trip_csv_by_name(spark, f"{tmp_dir}/csv").first()
    assert (r.trip_distance, r.PULocationID, r.DOLocationID, r.tip_amount, r.fare_amount) == (
        2.5, 132, 48, 3.0, 25.95,
    )
    assert read_trip_csv_by_name(spark, f"{tmp_dir}/csv").columns == TRIP_COLUMNS
    with pytest.raises(Exception):
        read_trip_csv(spark, f"{tmp_dir}/csv", TRIPS).collect()


def test_result_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.5)], "hour int, avg_fare double")
    write_result(df, f"{tmp_dir}/peak", "csv", single_file=True)
    back = read_result_csv(spark, f"{tmp_dir}/peak", df.schema)
    assert [tuple(r) for r in back.collect()] == [(1, 2.5)]
    assert read_result_csv(spark, f"{tmp_dir}/missing") is None
    write_result(df.limit(0), f"{tmp_dir}/empty", "csv", single_file=True)
    assert read_result_csv(spark, f"{tmp_dir}/empty", df.schema) is None
    require_columns(df, ["hour"])
    with pytest.raises(MissingColumns):
        require_columns(df, ["hour", "total_trips"])


def test_directory_probe_groups_by_folder(spark, tmp_dir):
    _metered_rows(spark, [1, 2, 3], "bigint").repartition(3).write.parquet(f"{tmp_dir}/2023-01")
    _metered_rows(spark, [4.0, 5.0], "double").repartition(2).write.parquet(f"{tmp_dir}/2023-02")
    scan = scan_feeds(spark, [f"{tmp_dir}/2023-01", f"{tmp_dir}/2023-02"], probe="directory")
    assert sorted(r.passenger_count for r in scan.trips.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_per_file_load_audit(spark, tmp_dir):
    from ridepulse.operators.audit import load_audit
    from ridepulse.sources.feeds import FILE_COL

    _metered_rows(spark, [1, 2, 3], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/m1")
    _metered_rows(spark, [4.0, 5.0], "double").coalesce(1).write.parquet(f"{tmp_dir}/m2")
    scan = scan_feeds(spark, [f"{tmp_dir}/m1", f"{tmp_dir}/m2"], with_file=True)
    audit = load_audit(scan.trips, by=["source", FILE_COL], checksum=True).collect()
    assert sorted(r.rows for r in audit) == [2, 3]
    again = load_audit(scan_feeds(spark, [f"{tmp_dir}/m2", f"{tmp_dir}/m1"]).trips, checksum=True).first()
    total = load_audit(scan.trips.drop(FILE_COL), checksum=True).first()
    assert again.checksum == total.checksum and again.rows == 5


def test_file_inventory(spark, tmp_dir):
    from ridepulse.sources.feeds import file_inventory, folder_sizes

    _metered_rows(spark, [1, 2, 3], "bigint").repartition(2).write.parquet(f"{tmp_dir}/a")
    _metered_rows(spark, [4.0], "double").coalesce(1).write.parquet(f"{tmp_dir}/b")
    inv = file_inventory(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"])
    sizes = {r.folder.rsplit("/", 1)[-1]: (r.files, r.bytes) for r in folder_sizes(inv).collect()}
    assert sizes["a"][0] == 2 and sizes["b"][0] == 1
    assert all(b > 0 for _, b in sizes.values())
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_file_missing_required_column_is_rejected(spark, tmp_dir):
    _metered_rows(spark, [1, 2], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/ok")
    _metered_rows(spark, [3], "bigint").drop("tip_amount").coalesce(1).write.parquet(f"{tmp_dir}/old")
    scan = scan_feeds(spark, [f"{tmp_dir}/ok", f"{tmp_dir}/old"])
    assert scan.trips.count() == 2
    reasons = [r.reason for r in scan.rejected.collect()]
    assert len(reasons) == 1 and "tip_amount" in reasons[0]
    # the stream layout fills the absent column instead
    stream = scan_feeds(spark, [f"{tmp_dir}/ok", f"{tmp_dir}/old"], layout="stream")
    assert stream.trips.count() == 3 and stream.rejected.count() == 0


def test_suggest_partitions_grows_with_input(spark):
    from conftest import SF_MID, SF_SMALL

    from ridepulse.plans import catalog
    from ridepulse.sources.feeds import suggest_partitions

    small = suggest_partitions(catalog.trips_union(spark, SF_SMALL))
    assert small == 1
    tiny_target = suggest_partitions(catalog.trips_union(spark, SF_MID), target_bytes=64 * 1024)
    assert tiny_target > suggest_partitions(catalog.trips_union(spark, SF_SMALL), target_bytes=64 * 1024) > 1


def test_distributed_probe(spark, tmp_dir):
    _metered_rows(spark, [1, 2, 3], "bigint").repartition(3).write.parquet(f"{tmp_dir}/m1")
    _metered_rows(spark, [4.0, 5.0], "double").repartition(2).write.parquet(f"{tmp_dir}/m2")
    os.makedirs(f"{tmp_dir}/bad", exist_ok=True)
    with open(f"{tmp_dir}/bad/broken.parquet", "wb") as fh:
        fh.write(b"not a parquet file")
    scan = scan_feeds(spark, [f"{tmp_dir}/m1", f"{tmp_dir}/m2", f"{tmp_dir}/bad"], probe="distributed")
    assert sorted(r.passenger_count for r in scan.trips.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert scan.schemas.count() == 2
    assert [os.path.basename(r.path) for r in scan.rejected.collect()] == ["broken.parquet"]


def test_ignore_missing_option_reads_normally(spark, tmp_dir):
    _metered_rows(spark, [1, 2], "bigint").coalesce(1).write.parquet(f"{tmp_dir}/m")
    scan = scan_feeds(spark, [f"{tmp_dir}/m"], ignore_missing=True)
    assert scan.trips.count() == 2 and scan.rejected.count() == 0


def test_missing_path_is_passed_over(spark, tmp_dir):
    _metered_rows(spark, [1, 2], "bigint").write.parquet(f"{tmp_dir}/m")
    scan = scan_feeds(spark, [f"{tmp_dir}/absent", f"{tmp_dir}/m"], ignore_missing=True)
    assert scan.trips.count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_feeds(spark, [f"{tmp_dir}/absent", f"{tmp_dir}/m"])


def test_unreadable_result_csv_is_none(spark, tmp_dir):
    from ridepulse.sources.results import read_result_csv

    with open(f"{tmp_dir}/bad.csv.gz", "wb") as fh:
        fh.write(b"this is no gzip file")
    assert read_result_csv(spark, f"{tmp_dir}/bad.csv.gz") is None
    assert read_result_csv(spark, f"{tmp_dir}/absent.csv") is None

"""Readers, writers and run history."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from zonalis.plans import preparation
from zonalis.plans.adapters import telemetry
from zonalis.sources import readers, writers


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_set_with_different_headers(spark, tmp_path):
    write(tmp_path / "1-probe.csv", "Year,Month,Date,svr1,Transfer size\n2024,1,5,1.5,\"1,024\"\n2024,x,6,2.5,3\n")
    write(tmp_path / "2-probe-b.csv", "svr1,Year,Month,Date,send_data\n7,2024,2,1.0,app\n")
    write(tmp_path / "3-probe-c.csv", "svr1,Year,Month,Date,send_data\n8,2024,2,2.0,app\n")
    write(tmp_path / "other.csv", "svr1\n9\n")
    df = readers.read_csv_glob(spark, f"{tmp_path}/*-probe*.csv")
    assert set(df.columns) == {"year", "month", "date", "svr1", "transfer_size", "send_data"}
    assert sorted(r.svr1 for r in df.collect()) == ["1.5", "2.5", "7", "8"]
    days = preparation.ingest(spark, f"{tmp_path}/*-probe*.csv")
    assert sorted(r.day_id for r in days.collect()) == ["2024-01-05", "2024-02-01", "2024-02-02"]
    with pytest.raises(FileNotFoundError):
        readers.read_csv_glob(spark, f"{tmp_path}/none*.csv")


def test_fallback_and_pairs(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    assert readers.read_first_existing(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_first_existing(spark, [f"{tmp_path}/x"])
    with pytest.raises(FileNotFoundError, match="test_part"):
        readers.read_train_test(spark, f"{tmp_path}/b", f"{tmp_path}/test_part")


def test_headers_that_differ_by_case_are_merged(spark):
    df = spark.createDataFrame([(None, 4, 1.0), (5, 6, 2.0)], "HOUR int, hour int, ` AVG_latencylag1 ` double")
    out = readers.normalize_headers(df)
    assert out.columns == ["hour", "avg_latency_lag1"]
    assert [r.hour for r in out.collect()] == [4, 5]


def test_results_table(spark, tmp_path):
    write(tmp_path / "gruResults.csv", "Target,MAE,RMSE,R^2\nAvg Latency (ms),1,2,bad\nupload-bitrate,3,x,0.5\n")
    rows = readers.read_results_table(spark, f"{tmp_path}/gruResults.csv").orderBy("target").collect()
    assert [tuple(r) for r in rows] == [("avg_latency", "gruResults", 1.0, 2.0, 4.0, None), ("upload_bitrate", "gruResults", 3.0, None, None, 0.5)]
    assert readers.read_results_table(spark, f"{tmp_path}/gruResults.csv", "GRU-lean-v2").first().model == "GRU"
    write(tmp_path / "bad.csv", "Target,MAE\na,1\n")
    with pytest.raises(ValueError, match="rmse"):
        readers.read_results_table(spark, f"{tmp_path}/bad.csv")


def test_days_are_folders_and_busy_days_split(spark, small, tmp_path):
    df = telemetry(spark, small).select("event_id", "day_id").withColumn(
        "day_id", F.when(F.col("event_id") % 3 == 0, F.lit(datetime.date(2024, 1, 1))).otherwise(F.col("day_id"))
    )
    path = f"{tmp_path}/days"
    writers.write_by_day(df, path, rows_per_file=50)
    hot = [f for f in os.listdir(f"{path}/day_id=2024-01-01") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(path).count() == df.count()


def test_run_history(spark, tmp_path):
    path = f"{tmp_path}/runs"
    writers.append_run_record(spark, path, "KMeans", {"k": 3}, {"silhouette": 0.5, "dbi": None})
    writers.append_run_record(spark, path, "DBSCAN", {"eps": 0.1}, {}, error="ValueError: no clusters")
    rows = readers_sorted = writers.read_run_history(spark, path).collect()
    assert [r.model for r in readers_sorted] == ["DBSCAN", "KMeans"]
    assert rows[1].params == {"k": "3"} and rows[1].metrics == {"silhouette": 0.5, "dbi": None} and rows[0].error.startswith("ValueError")


def test_cluster_assignments(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id long, features array<double>")
    labels = spark.createDataFrame([(1, 0), (2, -1)], "id long, label int")
    samples = spark.createDataFrame([(1, 0, 0.5, False)], "id long, label int, silhouette double, is_outlier boolean")
    writers.write_cluster_assignments(rows, labels, f"{tmp_path}/c", samples)
    out = spark.read.parquet(f"{tmp_path}/c").orderBy("id").collect()
    assert [(r.label, r.silhouette) for r in out] == [(0, 0.5), (-1, None)]


def test_files_to_features(spark, small, tmp_path):
    """Raw text files through every stage: nothing is null that has a source, nothing is lost but bad rows."""
    df = telemetry(spark, small)
    raw = df.select(
        F.date_format("ts", "yyyy").alias("Year"), F.month("ts").alias("Month"), F.dayofmonth("ts").alias("Date"), F.col("hour").alias("HOUR"),
        F.col("min").alias("MIN"), F.col("event_id").alias("time"), "latitude", "longitude", "svr1", "svr2", "svr3", "svr4",
        F.col("upload_mbps").alias("Bitrate"), F.lit("Mbits/sec").alias("bitrate_unit"), F.col("download_mbps").alias("Bitrate-RX"),
        F.lit("Mbits/sec").alias("bitrate_unit-RX"), "square_id",
    )
    raw.repartition(3).write.option("header", True).csv(f"{tmp_path}/x-probe.csv")
    train, test = preparation.prepare(spark, f"{tmp_path}/x-probe.csv", ["day_id", "hour", "min", "time"])
    good = df.filter(F.col("latitude") != 999).count()
    assert train.count() + test.count() == good
    for part in (train, test):
        for name in ("svr2", "svr4", "upload_mbps", "avg_latency", "avg_latency_lag1", "zone_avg_latency", "day_avg_latency", "total_throughput"):
            assert part.filter(F.col(name).isNull()).isEmpty(), name
        assert part.filter("latitude NOT BETWEEN -90 AND 90").isEmpty()
    assert train.agg(F.max("day_id")).first()[0] < test.agg(F.min("day_id")).first()[0]

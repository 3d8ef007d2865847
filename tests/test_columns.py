"""Edge tables for scalar expressions and filters."""

import pytest
from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions import predicates as p


def values(spark, schema, rows, *exprs):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [tuple(r)[1:] if len(exprs) > 1 else r[1] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_parse_number(spark):
    rows = [("1,024",), (" 5 ",), ("",), ("abc",), ("1.0d",), ("1_0",), ("1e3",), (None,), ("-.5",), ("7.",)]
    assert values(spark, "x string", rows, c.parse_number(F.col("x"))) == [1024.0, 5.0, None, None, None, None, 1000.0, None, -0.5, 7.0]


def test_units(spark):
    rows = [("1024", u) for u in ("KBytes", "kb", "GBytes", "MB", "other", None)]
    assert values(spark, "a string, u string", rows, c.size_to_mb(F.col("a"), F.col("u"))) == [1.0, 1.0, 1024.0 * 1024, 1024.0, 1024.0, 1024.0]
    rows = [("1024", u) for u in ("kbps", "kbits/sec", "Gbps", "MByte/s", "Mbits/sec", None)]
    assert values(spark, "a string, u string", rows, c.bitrate_to_mbps(F.col("a"), F.col("u"))) == [1.0, 1024.0, 1024.0 * 1024, 1024.0, 1024.0, 1024.0]


def test_bins(spark):
    hours = [(0.0,), (6.0,), (6.5,), (12.0,), (18.0,), (23.99,), (24.0,), (-1.0,), (None,)]
    want = ["night", "night", "morning", "morning", "afternoon", "evening", "evening", "night", None]
    assert values(spark, "h double", hours, c.time_of_day_bucket(F.col("h"))) == want
    assert values(spark, "h int", [(6,), (7,), (9,), (10,), (17,), (19,), (20,), (None,)], c.is_peak_hours(F.col("h"))) == [0, 1, 1, 0, 1, 1, 0, 0]
    latency = [(0.0,), (50.0,), (50.1,), (100.0,), (200.0,), (1e9,), (-1.0,), (None,)]
    assert values(spark, "l double", latency, c.latency_quality(F.col("l"))) == ["excellent", "excellent", "good", "good", "fair", "poor", None, "excellent"]
    rate = [(0.0,), (10.0,), (50.0,), (100.0,), (100.1,), (None,)]
    assert values(spark, "t double", rate, c.throughput_quality(F.col("t"))) == ["poor", "poor", "fair", "good", "excellent", "poor"]


def test_row_stats_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0, None), (None, None, None, None), (2.0, None, None, None)], "svr1 double, svr2 double, svr3 double, svr4 double")
    rows = c.row_stats(df).select("avg_latency", "min_latency", "max_latency", "std_latency", "latency_range").collect()
    assert [tuple(r) for r in rows] == [(2.0, 1.0, 3.0, pytest.approx(2 ** 0.5), 2.0), (None,) * 5, (2.0, 2.0, 2.0, None, 0.0)]


def test_rounding_is_half_even(spark):
    assert values(spark, "x double", [(1.0005,), (2.5e-3,)], c.rounded(F.col("x"), 3)) == [1.0, 0.002]


def test_invalid_gps_keeps_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (0.0, 1.0), (99.999, 1.0), (5.0, 999.999), (5.0, 6.0), (90.0, -180.0)], "latitude double, longitude double")
    kept = p.drop_invalid_gps(df).collect()
    assert [tuple(r) for r in kept] == [(None, 1.0), (5.0, 6.0), (90.0, -180.0)]
    flags = [r[0] for r in spark.createDataFrame([(None, 1.0), (91.0, 0.0), (90.0, -180.0), (0.0, 181.0)], "latitude double, longitude double").select(p.gps_out_of_range()).collect()]
    assert flags == [False, True, False, True]


def test_day_parts(spark):
    rows = [("2024", "1", "5.0"), ("2024", "x", "5"), ("2024", "12", "31"), (None, "1", "1")]
    assert values(spark, "y string, m string, d string", rows, c.make_day_id(F.col("y"), F.col("m"), F.col("d"))) == ["2024-01-05", None, "2024-12-31", None]


def test_date_key_priority(spark):
    df = spark.createDataFrame([("2024-3-1", "2023-01-01"), (None, "2023-01-02")], "dates string, day_id string")
    assert [str(r[0]) for r in c.derive_date_key(df).select("date_key").collect()] == ["2024-03-01", "None"]
    empty = spark.createDataFrame([(None, "2023-1-2")], "dates string, day_id string")
    assert str(c.derive_date_key(empty).first()["date_key"]) == "2023-01-02"
    with pytest.raises(ValueError):
        c.derive_date_key(spark.createDataFrame([(1,)], "x int"))


def test_labels(spark):
    rows = [(" AVG-Latency (ms)",), ("Upload   Mbps",), ("ping_time",), (None,)]
    assert values(spark, "x string", rows, c.canonical_target_label(F.col("x"))) == ["avg_latency", "upload_bitrate", "ping_time", None]
    rows = [("GRU-lean-v2",), (" xgboost ",), ("Prophet",)]
    assert values(spark, "x string", rows, c.canonical_model_label(F.col("x"))) == ["GRU", "XGBoost", "Prophet"]


def test_clean_measurements_fills_absent_columns(spark):
    df = spark.createDataFrame([("1,0", "KBytes", "5", "a", "sq")], "transfer_size string, transfer_unit string, latitude string, send_data string, square_id string")
    df = df.withColumn("longitude", F.lit("6"))
    row = c.clean_measurements(df).first()
    assert row.upload_mb == 10 / 1024 and row.download_mbps is None and row.application_data == "a" and row.day_id is None
    assert [f.name for f in c.clean_measurements(df).schema.fields] == c.CLEAN_SCHEMA.names


def test_drop_sparse_columns(spark):
    df = spark.createDataFrame([(1, 7, None, "a"), (2, 7, None, "b")], "i int, same int, empty double, t string")
    assert p.drop_sparse_columns(df).columns == ["i", "t"]

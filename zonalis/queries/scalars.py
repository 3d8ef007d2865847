"""Queries for scalar projections (C) and filters (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions import predicates as p
from zonalis.plans.adapters import raw_text, telemetry
from zonalis.queries.registry import NUDGE, query, r6
from zonalis.queries.results import results

NUM = "CASE WHEN regexp_matches({b}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST({b} AS DOUBLE) END"


def num(x: str) -> str:
    """DuckDB text for a lenient number parse of column ``x``."""
    return NUM.format(b=f"trim(replace({x}, ',', ''))")


@query("parse_number", f"SELECT event_id, {num('transfer_size')} AS number FROM raw_text", ("raw_text",))
def _(spark, sf):
    return raw_text(spark, sf).select("event_id", c.parse_number(F.col("transfer_size")).alias("number"))


@query("size_to_mb", f"""
SELECT event_id, round(CASE WHEN lower(transfer_unit) IN ('kb', 'kbyte', 'kbytes') THEN n / 1024e0
  WHEN lower(transfer_unit) IN ('gb', 'gbyte', 'gbytes') THEN n * 1024e0 ELSE n END + {NUDGE}, 6) AS upload_mb
FROM (SELECT *, {num('transfer_size')} AS n FROM raw_text) x""", ("raw_text",))
def _(spark, sf):
    return r6(raw_text(spark, sf).select("event_id", c.size_to_mb(F.col("transfer_size"), F.col("transfer_unit")).alias("upload_mb")), nudge=NUDGE)


@query("bitrate_to_mbps", f"""
SELECT event_id, round(CASE WHEN lower(bitrate_unit) IN ('kb/s', 'kbps') THEN n / 1024e0
  WHEN lower(bitrate_unit) IN ('gb/s', 'gbps') THEN n * 1024e0 ELSE n END + {NUDGE}, 6) AS upload_mbps
FROM (SELECT *, {num('bitrate')} AS n FROM raw_text) x""", ("raw_text",))
def _(spark, sf):
    return r6(raw_text(spark, sf).select("event_id", c.bitrate_to_mbps(F.col("bitrate"), F.col("bitrate_unit")).alias("upload_mbps")), nudge=NUDGE)


@query("conform_schema", f"""
SELECT TRY_CAST(time AS BIGINT) AS time, CAST(NULL AS DATE) AS day_id, CAST(NULL AS TIMESTAMP) AS convert_time,
  CAST(NULL AS INT) AS hour, CAST(NULL AS INT) AS min, CAST(NULL AS INT) AS sec,
  {num('latitude')} AS latitude, {num('longitude')} AS longitude,
  CAST(NULL AS DOUBLE) AS svr1, CAST(NULL AS DOUBLE) AS svr2, CAST(NULL AS DOUBLE) AS svr3, CAST(NULL AS DOUBLE) AS svr4,
  round(CASE WHEN lower(transfer_unit) IN ('kb', 'kbyte', 'kbytes') THEN n / 1024e0
    WHEN lower(transfer_unit) IN ('gb', 'gbyte', 'gbytes') THEN n * 1024e0 ELSE n END + {NUDGE}, 6) AS upload_mb,
  round(CASE WHEN lower(bitrate_unit) IN ('kb/s', 'kbps') THEN b / 1024e0
    WHEN lower(bitrate_unit) IN ('gb/s', 'gbps') THEN b * 1024e0 ELSE b END + {NUDGE}, 6) AS upload_mbps,
  CAST(NULL AS DOUBLE) AS download_mb, CAST(NULL AS DOUBLE) AS download_mbps,
  send_data AS application_data, square_id
FROM (SELECT *, {num('transfer_size')} AS n, {num('bitrate')} AS b FROM raw_text) x""", ("raw_text",))
def _(spark, sf):
    return r6(c.clean_measurements(raw_text(spark, sf)), "upload_mb", "upload_mbps", nudge=NUDGE)


@query("coerce_numeric", f"""
SELECT event_id, {num('transfer_size')} AS transfer_size, {num('bitrate')} AS bitrate, {num('month')} AS month, {num('date')} AS date
FROM raw_text""", ("raw_text",))
def _(spark, sf):
    names = ["transfer_size", "bitrate", "month", "date"]
    return c.coerce_numeric(raw_text(spark, sf).select("event_id", *names), names)


@query("make_day_id", f"""
SELECT event_id, year || '-' || lpad(CAST(CAST({num('month')} AS BIGINT) AS VARCHAR), 2, '0') || '-' ||
  lpad(CAST(CAST({num('date')} AS BIGINT) AS VARCHAR), 2, '0') AS day_id FROM raw_text""", ("raw_text",))
def _(spark, sf):
    return raw_text(spark, sf).select("event_id", c.make_day_id(F.col("year"), F.col("month"), F.col("date")).alias("day_id"))


@query("derive_date_key", "SELECT event_id, TRY_CAST(dates AS DATE) AS date_key FROM raw_text", ("raw_text",))
def _(spark, sf):
    return c.derive_date_key(raw_text(spark, sf)).select("event_id", "date_key")


@query("unix_to_timestamp", """
SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds(TRY_CAST(time AS BIGINT)) AS stamp FROM raw_text""", ("raw_text",))
def _(spark, sf):
    return raw_text(spark, sf).select("event_id", c.unix_to_timestamp(F.col("time")).alias("stamp"))


@query("calendar_parts", "SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour, dayname(ts) AS day_name FROM events")
def _(spark, sf):
    return c.calendar_parts(telemetry(spark, sf), "ts").select("event_id", "date", "hour", "day_name")


@query("time_features", """
SELECT event_id, hour AS hour_of_day, min AS minute, CAST(day_id AS VARCHAR) AS day_of_week FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return c.time_features(telemetry(spark, sf)).select("event_id", "hour_of_day", "minute", "day_of_week")


@query("time_of_day_bucket", """
SELECT event_id, CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning' WHEN hour <= 18 THEN 'afternoon'
  ELSE 'evening' END AS time_of_day FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return telemetry(spark, sf).select("event_id", c.time_of_day_bucket(F.col("hour")).alias("time_of_day"))


@query("is_peak_hours", """
SELECT event_id, CAST(hour IN (7, 8, 9, 17, 18, 19) AS INT) AS is_peak_hours FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return telemetry(spark, sf).select("event_id", c.is_peak_hours(F.col("hour")).alias("is_peak_hours"))


@query("row_stats", """
SELECT event_id, round(list_avg(v), 6) AS avg_latency, round(list_min(v), 6) AS min_latency, round(list_max(v), 6) AS max_latency,
  round(CASE WHEN len(v) > 1 THEN list_stddev_samp(v) END, 6) AS std_latency, round(list_max(v) - list_min(v), 6) AS latency_range
FROM (SELECT event_id, list_filter([svr1, svr2, svr3, svr4], lambda x : x IS NOT NULL) AS v FROM telemetry) t""", ("telemetry",))
def _(spark, sf):
    out = c.row_stats(telemetry(spark, sf))
    return r6(out.select("event_id", "avg_latency", "min_latency", "max_latency", "std_latency", "latency_range"))


@query("latency_quality", """
SELECT event_id, CASE WHEN l < 0 THEN NULL WHEN l <= 50 THEN 'excellent' WHEN l <= 100 THEN 'good' WHEN l <= 200 THEN 'fair'
  ELSE 'poor' END AS latency_quality
FROM (SELECT event_id, coalesce(svr4, 0) AS l FROM telemetry) t""", ("telemetry",))
def _(spark, sf):
    return telemetry(spark, sf).select("event_id", c.latency_quality(F.col("svr4")).alias("latency_quality"))


@query("throughput_features", """
SELECT event_id, round(upload_mbps + download_mbps, 6) AS total_throughput,
  round(upload_mbps / (download_mbps + 1e-6), 3) AS upload_download_ratio FROM telemetry""", ("telemetry",))
def _(spark, sf):
    out = c.throughput_features(telemetry(spark, sf)).select("event_id", "total_throughput", "upload_download_ratio")
    return r6(r6(out, "total_throughput"), "upload_download_ratio", places=3)


@query("throughput_quality", """
SELECT event_id, CASE WHEN t <= 10 THEN 'poor' WHEN t <= 50 THEN 'fair' WHEN t <= 100 THEN 'good' ELSE 'excellent' END AS throughput_quality
FROM (SELECT event_id, coalesce(upload_mbps + download_mbps, 0) AS t FROM telemetry) x""", ("telemetry",))
def _(spark, sf):
    out = c.throughput_features(telemetry(spark, sf))
    return out.select("event_id", c.throughput_quality(F.col("total_throughput")).alias("throughput_quality"))


@query("location_hash", """
SELECT event_id, lat_rounded, lon_rounded, CAST(lat_rounded AS VARCHAR) || '_' || CAST(lon_rounded AS VARCHAR) AS location_hash
FROM (SELECT event_id, round_even(latitude * 1e3, 0) / 1e3 AS lat_rounded, round_even(longitude * 1e3, 0) / 1e3 AS lon_rounded FROM telemetry) t
""", ("telemetry",))
def _(spark, sf):
    return c.location_hash(telemetry(spark, sf)).select("event_id", "lat_rounded", "lon_rounded", "location_hash")


ROW_FEATURES = """
SELECT *, list_avg(v) AS avg_latency, CASE WHEN len(v) > 1 THEN list_stddev_samp(v) END AS std_latency,
  upload_mbps + download_mbps AS total_throughput
FROM (SELECT *, list_filter([svr1, svr2, svr3, svr4], lambda x : x IS NOT NULL) AS v FROM telemetry) t
"""


@query("clustering_projection", """
SELECT square_id, latitude, longitude, round(avg_latency, 6) AS avg_latency, round(std_latency, 6) AS std_latency,
  round(total_throughput, 6) AS total_throughput FROM featured""", ("telemetry",), {"featured": ROW_FEATURES})
def _(spark, sf):
    out = c.clustering_projection(c.throughput_features(c.row_stats(telemetry(spark, sf))))
    return r6(out, "avg_latency", "std_latency", "total_throughput")


@query("forecasting_projection", """
SELECT hour, day_id, CAST(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS INT) AS is_peak_hours, square_id,
  round(avg_latency, 6) AS avg_latency, upload_mbps AS upload_bitrate, download_mbps AS download_bitrate
FROM featured""", ("telemetry",), {"featured": ROW_FEATURES})
def _(spark, sf):
    out = c.row_stats(telemetry(spark, sf)).withColumn("is_peak_hours", c.is_peak_hours(F.col("hour")))
    return r6(c.forecasting_projection(out), "avg_latency")


TARGET_CASE = """CASE regexp_replace(regexp_replace(lower(trim(target_raw)), '[-_]', ' ', 'g'), ' +', ' ', 'g')
  WHEN 'avg latency (ms)' THEN 'avg_latency' WHEN 'upload bitrate' THEN 'upload_bitrate' WHEN 'download mbps' THEN 'download_bitrate' END"""
MODEL_CASE = """CASE trim(model_raw) WHEN 'GRU-lean-v2' THEN 'GRU' WHEN 'xgboost' THEN 'XGBoost' WHEN 'arima' THEN 'ARIMA'
  WHEN 'srnn' THEN 'SRNN' ELSE trim(model_raw) END"""
RESULTS = f"SELECT {TARGET_CASE} AS target, {MODEL_CASE} AS model, mae, rmse, rmse * rmse AS mse, r2 FROM model_results_raw"


@query("canonical_target_label", f"SELECT target_raw, model_raw, {TARGET_CASE} AS target FROM model_results_raw", ("model_results_raw",))
def _(spark, sf):
    from zonalis.plans.adapters import model_results_raw
    return model_results_raw(spark, sf).select("target_raw", "model_raw", c.canonical_target_label(F.col("target_raw")).alias("target"))


@query("canonical_model_label", f"SELECT target_raw, model_raw, {MODEL_CASE} AS model FROM model_results_raw", ("model_results_raw",))
def _(spark, sf):
    from zonalis.plans.adapters import model_results_raw
    return model_results_raw(spark, sf).select("target_raw", "model_raw", c.canonical_model_label(F.col("model_raw")).alias("model"))


@query("clean_non_finite", """
SELECT event_id, CASE WHEN isfinite(x) THEN x END AS cleaned
FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST('inf' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST('nan' AS DOUBLE) ELSE svr4 END AS x
      FROM telemetry) t""", ("telemetry",))
def _(spark, sf):
    spoiled = (
        F.when(F.col("event_id") % 3 == 0, float("inf")).when(F.col("event_id") % 5 == 0, float("nan")).otherwise(F.col("svr4"))
    )
    return telemetry(spark, sf).select("event_id", c.clean_non_finite(spoiled).alias("cleaned"))


@query("derive_mse", "SELECT target, model, round(mse, 6) AS mse FROM results", ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    return r6(results(spark, sf).select("target", "model", c.derive_mse(F.col("rmse")).alias("mse")))


@query("select_by_dtype", """
SELECT 'svr2' AS column_name, count(*) FILTER (svr2 IS NULL) AS null_count FROM telemetry
UNION ALL SELECT 'svr3', count(*) FILTER (svr3 IS NULL) FROM telemetry
UNION ALL SELECT 'svr4', count(*) FILTER (svr4 IS NULL) FROM telemetry
UNION ALL SELECT 'upload_mbps', count(*) FILTER (upload_mbps IS NULL) FROM telemetry
UNION ALL SELECT 'download_mbps', count(*) FILTER (download_mbps IS NULL) FROM telemetry""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf)
    return c.null_counts(df, c.numeric_columns(df, [*c.NOT_TELEMETRY, "event_id"])).filter("null_count > 0")


GPS_BAD = "(0e0, 99.999e0, 99.9999e0, 999e0, 999.999e0)"


@query("drop_invalid_gps", f"""
SELECT event_id, latitude, longitude FROM (SELECT event_id, {num('latitude')} AS latitude, {num('longitude')} AS longitude FROM raw_text) t
WHERE NOT coalesce(latitude IN {GPS_BAD}, false) AND NOT coalesce(longitude IN {GPS_BAD}, false)""", ("raw_text",))
def _(spark, sf):
    out = c.coerce_numeric(raw_text(spark, sf), ["latitude", "longitude"])
    return p.drop_invalid_gps(out).select("event_id", "latitude", "longitude")


@query("require_valid_date", f"""
SELECT event_id, year, month, date FROM raw_text
WHERE {num('year')} IS NOT NULL AND {num('month')} IS NOT NULL AND {num('date')} IS NOT NULL""", ("raw_text",))
def _(spark, sf):
    return p.require_valid_date(raw_text(spark, sf)).select("event_id", "year", "month", "date")


@query("drop_null_rows", """
SELECT event_id, svr2, svr3, svr4 FROM telemetry WHERE svr2 IS NOT NULL AND svr3 IS NOT NULL AND svr4 IS NOT NULL""", ("telemetry",))
def _(spark, sf):
    return p.drop_null_rows(telemetry(spark, sf).select("event_id", "svr2", "svr3", "svr4"))


@query("split_known_unknown", """
SELECT event_id, square_id, square_id <> 'Unknown' AS is_known FROM raw_text""", ("raw_text",))
def _(spark, sf):
    known, unknown = p.split_known_unknown(raw_text(spark, sf).select("event_id", "square_id"))
    return known.withColumn("is_known", F.lit(True)).unionByName(unknown.withColumn("is_known", F.lit(False)))


@query("filter_models", "SELECT target, model, mae FROM results WHERE model IN ('GRU', 'XGBoost')", ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    return p.filter_models(results(spark, sf), ["GRU", "XGBoost"]).select("target", "model", "mae")


@query("mask_noise", "SELECT vec_id, label - 1 AS label FROM embeddings WHERE label - 1 <> -1")
def _(spark, sf):
    from zonalis.plans.adapters import vectors
    return p.mask_noise(vectors(spark, sf).select("vec_id", (F.col("label") - 1).alias("label")))


@query("drop_sparse_columns", "SELECT event_id, square_id FROM telemetry", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).select("event_id", "square_id", F.lit(None).cast("double").alias("empty"), F.lit(7).alias("same"))
    return p.drop_sparse_columns(df)


@query("gps_range_check", """
SELECT event_id, coalesce(latitude NOT BETWEEN -90 AND 90, false) OR coalesce(longitude NOT BETWEEN -180 AND 180, false) AS out_of_range
FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return telemetry(spark, sf).select("event_id", p.gps_out_of_range().alias("out_of_range"))

"""Telemetry-shaped views over the given tables.

Each view is stated once as SQL expressions that Spark and DuckDB both accept, so a query and its check read the
same rows. Constants use exponent form to stay doubles in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENT_BASE = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"

TELEMETRY = [
    "event_id",
    "ts",
    "CAST(ts AS DATE) AS day_id",
    "CAST(hour(ts) AS INT) AS hour",
    "CAST(minute(ts) AS INT) AS min",
    "CAST(second(ts) AS INT) AS sec",
    "CASE WHEN event_id % 41 = 0 THEN NULL ELSE concat('sq_', CAST(user_id AS STRING)) END AS square_id",
    "CASE WHEN event_id % 97 = 0 THEN 999e0 ELSE 50e0 + (user_id % 10) * 1e-2 + k * 1e-4 END AS latitude",
    "8e0 + (user_id % 7) * 1e-2 + k * 1e-4 AS longitude",
    "value AS svr1",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 5e-1 + k END AS svr2",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value + k END AS svr3",
    "CASE WHEN event_type = 'error' THEN NULL ELSE 2e0 * k + 1e0 END AS svr4",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE k * 25e-2 END AS upload_mbps",
    "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value * 125e-3 END AS download_mbps",
]

RAW = [
    "event_id",
    "CASE WHEN event_id % 19 = 0 THEN 'n/a' WHEN event_id % 5 = 0 THEN concat(' ', CAST(k AS STRING), ',024 ') "
    "WHEN event_id % 23 = 0 THEN concat(CAST(k AS STRING), '_0') ELSE CAST(value AS STRING) END AS transfer_size",
    "CASE event_id % 6 WHEN 0 THEN 'KBytes' WHEN 1 THEN 'MBytes' WHEN 2 THEN 'GBytes' WHEN 3 THEN 'kb' "
    "WHEN 4 THEN NULL ELSE 'unknown' END AS transfer_unit",
    "CASE WHEN event_id % 29 = 0 THEN '' ELSE CAST(k AS STRING) END AS bitrate",
    "CASE event_id % 6 WHEN 0 THEN 'kbps' WHEN 1 THEN 'Mbits/sec' WHEN 2 THEN 'Gbps' WHEN 3 THEN 'kbits/sec' "
    "WHEN 4 THEN NULL ELSE 'MByte/s' END AS bitrate_unit",
    "CAST(year(ts) AS STRING) AS year",
    "CASE WHEN event_id % 31 = 0 THEN 'x' ELSE CAST(month(ts) AS STRING) END AS month",
    "CASE WHEN event_id % 37 = 0 THEN NULL ELSE concat(CAST(day(ts) AS STRING), '.0') END AS date",
    "CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS dates",
    "CASE WHEN event_id % 47 = 0 THEN 'bad' ELSE CAST(1704067200 + event_id * 60 AS STRING) END AS time",
    "CASE WHEN event_id % 97 = 0 THEN '999.0' WHEN event_id % 89 = 0 THEN NULL "
    "ELSE CAST(50 + (user_id % 10) AS STRING) END AS latitude",
    "CASE WHEN event_id % 53 = 0 THEN '0.0' ELSE CAST(8 + (user_id % 7) AS STRING) END AS longitude",
    "event_type AS send_data",
    "CASE WHEN event_id % 41 = 0 THEN 'Unknown' ELSE concat('sq_', CAST(user_id AS STRING)) END AS square_id",
]


def _sql(columns: list[str]) -> str:
    return f"SELECT {', '.join(columns)} FROM (SELECT *, {EVENT_BASE} FROM events) base"


TELEMETRY_SQL = _sql(TELEMETRY)
RAW_SQL = _sql(RAW)

# Error table of simple predictors per label spelling, aggregated from all events.
RESULTS_SQL = """
SELECT target_raw, model_raw,
       round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse,
       CASE WHEN model_raw = ' arima' THEN NULL ELSE round(1e0 - avg(e * e) / (1e0 + avg(y * y)), 6) END AS r2
FROM (
  SELECT CASE event_id % 3 WHEN 0 THEN ' AVG-Latency (ms)' WHEN 1 THEN 'upload_bitrate' ELSE 'Download   Mbps' END AS target_raw,
         CASE event_id % 5 WHEN 0 THEN 'GRU-lean-v2' WHEN 1 THEN 'xgboost' WHEN 2 THEN ' arima' WHEN 3 THEN 'Prophet' ELSE 'srnn' END AS model_raw,
         value AS y, value - k * (5e-1 + (event_id % 5) * 1e-1) AS e
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) base
) residuals
GROUP BY target_raw, model_raw
"""

# Trial table shaped like a clustering sweep: one row per setting, figures aggregated from all events.
TRIALS_SQL = """
SELECT CASE g % 4 WHEN 0 THEN 'KMeans' WHEN 1 THEN 'DBSCAN' WHEN 2 THEN 'Birch' ELSE 'HDBSCAN' END AS model,
       concat('setting=', CAST(g AS STRING)) AS param,
       CASE WHEN g = 5 THEN NULL ELSE round(avg(k) / 1e2 - (g % 3) * 1e-1, 2) END AS silhouette,
       round(avg(value) / 1e1 + g * 1e-2, 3) AS dbi,
       round(avg(value * k) / 1e1, 3) AS calinski_harabasz,
       CAST(g % 6 AS BIGINT) AS n_outliers, CAST(2 + g % 7 AS BIGINT) AS n_clusters
FROM (SELECT *, event_id % 24 AS g, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) base
GROUP BY g
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _view(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr("*", EVENT_BASE).selectExpr(*columns)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TELEMETRY)


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW)


def model_results_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RESULTS_SQL.replace("FROM events", "FROM {events}"), events=read(spark, sf_dir, "events"))


def cluster_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRIALS_SQL.replace("FROM events", "FROM {events}"), events=read(spark, sf_dir, "events"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS features", "label")

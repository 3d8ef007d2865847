"""Queries for forecasting (N), forecast comparison (O), readers (A) and writers (B)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.operators import forecast_metrics as fm
from zonalis.operators import forecasting as fc
from zonalis.operators import windows as w
from zonalis.operators.aggregates import hourly_resample
from zonalis.plans import comparison, preparation
from zonalis.plans.adapters import raw_text, read, telemetry
from zonalis.plans.materialize import materialize
from zonalis.queries.groups import MEDIANS, splits
from zonalis.queries.registry import query, r6
from zonalis.queries.results import results
from zonalis.queries.scalars import RESULTS, num
from zonalis.queries.space import SVR, knn_column, vec
from zonalis.session import shared_dir
from zonalis.sources import readers, writers


def fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/zonalis-{name}-{uuid.uuid4().hex}"


# --- readers and writers --------------------------------------------------------------------------------------------------

RAW_COLUMNS = ["event_id", "transfer_size", "bitrate", "month", "send_data", "square_id"]


@query("read_csv_glob", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {', '.join(f"nullif({n}, '') AS {n}" if n == 'bitrate' else n for n in RAW_COLUMNS[1:])} FROM raw_text WHERE event_id % 2 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), {', '.join('NULL' if n == 'send_data' else f"nullif({n}, '')" if n == 'bitrate' else n for n in RAW_COLUMNS[1:])} FROM raw_text WHERE event_id % 2 = 1""",
       ("raw_text",))
def _(spark, sf):
    folder = fresh(spark, "raw")
    df = raw_text(spark, sf).select(*RAW_COLUMNS)
    # two file groups with different headers, as raw exports have
    first = df.filter("event_id % 2 = 0").withColumnsRenamed({"transfer_size": "Transfer size", "square_id": "Square_ID"})
    first.write.option("header", True).options(emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/a-probe1.csv")
    df.filter("event_id % 2 = 1").drop("send_data").write.option("header", True).options(emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/b-probe2.csv")
    return readers.read_csv_glob(spark, f"{folder}/*-probe*.csv").select(*RAW_COLUMNS)


@query("read_first_existing", "SELECT event_id, value FROM events")
def _(spark, sf):
    return readers.read_first_existing(spark, [f"{sf}/missing.parquet", f"{sf}/events.parquet", f"{sf}/orders.parquet"]).select("event_id", "value")


@query("read_train_test", "SELECT event_id, day_id, day_id >= DATE '2024-01-25' AS is_test FROM telemetry", ("telemetry",))
def _(spark, sf):
    paths = [fresh(spark, "train"), fresh(spark, "test")]
    for df, path in zip(splits(spark, sf), paths):
        writers.write_table(df, path)
    train, test = readers.read_train_test(spark, *paths)
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))).select("event_id", "day_id", "is_test")


@query("normalize_headers", """
SELECT event_id, svr1 AS avg_latency, upload_mbps AS upload_bitrate, coalesce(svr2, svr3) AS hour FROM telemetry""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).select("event_id", "svr1", "upload_mbps", "svr2", "svr3")
    return readers.normalize_headers(df.toDF("Event_ID", " AVG_latency ", "Upload_Bitrate_Mbits/sec", "HOUR", "hour"))


@query("read_results_table", "SELECT target, model, mae, rmse, round(mse, 6) AS mse, r2 FROM results", ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    from zonalis.plans.adapters import model_results_raw

    path = fresh(spark, "results") + ".csv"
    writers.write_table(model_results_raw(spark, sf).withColumnsRenamed({"target_raw": "Target", "model_raw": "Model", "r2": "R^2"}), path, "csv")
    return r6(readers.read_results_table(spark, path), "mse")


@query("write_table", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    path = fresh(spark, "table")
    writers.write_table(read(spark, sf, "orders").select("o_orderkey", "o_totalprice"), path)
    return readers.read_table(spark, path)


@query("write_by_day", "SELECT event_id, square_id, day_id FROM telemetry", ("telemetry",))
def _(spark, sf):
    path = fresh(spark, "days")
    df = telemetry(spark, sf).select("event_id", "square_id", "day_id")
    writers.write_by_day(df, path)
    return spark.read.schema(df.schema).parquet(path)


@query("write_json_summary", "SELECT event_type, count(*) AS rows, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def _(spark, sf):
    path = fresh(spark, "summary")
    df = r6(read(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.avg("value").alias("mean_value")))
    writers.write_json_summary(df, path)
    return spark.read.schema(df.schema).json(path)


@query("append_run_record", """
SELECT 'SeasonalNaive' AS model, 'svr1' AS target, '1' AS lag, round(avg(abs(e)), 6) AS mae FROM (SELECT svr1 - lag(svr1) OVER (ORDER BY ts, event_id) AS e FROM telemetry) t
UNION ALL SELECT 'Mean', 'svr1', '0', round(avg(abs(svr1 - (SELECT avg(svr1) FROM telemetry))), 6) FROM telemetry""", ("telemetry",))
def _(spark, sf):
    path = fresh(spark, "runs")
    df = telemetry(spark, sf).select("event_id", "ts", "svr1")
    lagged = w.lag_features(df, [], ["ts", "event_id"], ["svr1"]).withColumnRenamed("svr1_lag1", "guess")
    mean = df.withColumn("guess", F.lit(df.agg(F.avg("svr1")).first()[0]))
    for model, lag, guess in (("SeasonalNaive", 1, lagged), ("Mean", 0, mean)):
        writers.append_run_record(spark, path, model, {"lag": lag}, fm.regression_metrics(guess, [], "svr1", "guess").first().asDict(), "svr1")
    out = writers.read_run_history(spark, path)
    return r6(out.select("model", "target", F.col("params")["lag"].alias("lag"), F.col("metrics")["mae"].alias("mae")))


@query("write_cluster_assignments", """
SELECT vec_id AS id, CAST(label AS BIGINT) AS label, round(embedding[1], 6) AS first_feature FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings) e""")
def _(spark, sf):
    path = fresh(spark, "assignments")
    df = vec(spark, sf)
    writers.write_cluster_assignments(df.select("id", "features"), df.select("id", "label"), path)
    return r6(readers.read_table(spark, path).select("id", "label", F.col("features")[0].alias("first_feature")))


# --- series ---------------------------------------------------------------------------------------------------------------

HOURLY = "SELECT date_trunc('hour', ts) AS hour_start, avg(svr1) AS y FROM telemetry GROUP BY 1"
NAIVE = f"SELECT hour_start, y, lag(y) OVER (ORDER BY hour_start) AS guess FROM ({HOURLY}) h"


def hourly(spark, sf):
    return hourly_resample(telemetry(spark, sf), ["svr1"]).withColumnRenamed("svr1", "y")


def naive(spark, sf):
    return w.lag_features(hourly(spark, sf), [], ["hour_start"], ["y"]).withColumnRenamed("y_lag1", "guess")


@query("residuals", "SELECT hour_start, round(y - guess, 6) AS residual FROM naive", ("telemetry",), {"naive": NAIVE})
def _(spark, sf):
    return r6(fc.residuals(naive(spark, sf), "y", "guess").select("hour_start", "residual"))


@query("fit_information", """
SELECT count(*) AS n, round(count(*) * ln(avg(e * e)) + 4, 6) AS aic, round(count(*) * ln(avg(e * e)) + 2 * ln(count(*)), 6) AS bic,
  round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM (SELECT y - guess AS e FROM naive WHERE guess IS NOT NULL) r""",
       ("telemetry",), {"naive": NAIVE})
def _(spark, sf):
    return r6(fc.fit_information(fc.residuals(naive(spark, sf), "y", "guess"), [], "y", "residual", 2))


@query("arma_forecast")
def _(spark, sf):
    df = telemetry(spark, sf).select("event_id", "ts", "svr1")
    return fc.arma_forecast(df, [], ["ts", "event_id"], "svr1", steps=100)


@query("arma_forecast_by_zone")
def _(spark, sf):
    df = telemetry(spark, sf).filter(F.col("square_id").isNotNull()).select("square_id", "event_id", "ts", "svr1")
    return fc.arma_forecast(df, ["square_id"], ["ts", "event_id"], "svr1")


@query("ar_coefficients", """
SELECT round(regr_slope(y, guess), 6) AS slope, round(regr_intercept(y, guess), 6) AS intercept FROM naive""", ("telemetry",), {"naive": NAIVE})
def _(spark, sf):
    fit = fc.fit_series(hourly(spark, sf), [], ["hour_start"], "y", pdq=(1, 0, 0))
    return r6(fit.coefficients.select(F.col("beta")[1].alias("slope"), F.col("beta")[0].alias("intercept")))


ZONE_PAIRS = """SELECT square_id, ts, event_id, svr1 AS y, lag(svr1) OVER (PARTITION BY square_id ORDER BY ts, event_id) AS guess
FROM telemetry WHERE square_id IS NOT NULL"""


@query("series_information", """
SELECT square_id, count(*) AS n, round(count(*) * ln(avg(e * e)) + 6, 6) AS aic, round(count(*) * ln(avg(e * e)) + 3 * ln(count(*)), 6) AS bic,
  round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse FROM errors WHERE e IS NOT NULL GROUP BY square_id HAVING count(*) >= 10""",
       ("telemetry",), {
    "pairs": ZONE_PAIRS,
    "fits": "SELECT square_id, regr_slope(y, guess) AS b, regr_intercept(y, guess) AS a FROM pairs GROUP BY square_id",
    "errors": "SELECT square_id, y - a - b * guess AS e FROM pairs JOIN fits USING (square_id)",
})
def _(spark, sf):
    df = telemetry(spark, sf).filter(F.col("square_id").isNotNull()).select("square_id", "event_id", "ts", "svr1")
    return r6(fc.series_information(df, ["square_id"], ["ts", "event_id"], "svr1", (1, 0, 0)).filter("n >= 10"))


@query("ar_forecast", """
SELECT square_id, CAST(step AS INTEGER) AS step, round(y, 6) AS forecast FROM ahead WHERE step > 0""", ("telemetry",), {
    "pairs": """SELECT square_id, ts, event_id, svr1 AS y, lag(svr1) OVER (PARTITION BY square_id ORDER BY ts, event_id) AS guess,
  row_number() OVER (PARTITION BY square_id ORDER BY ts DESC, event_id DESC) AS back FROM telemetry WHERE square_id IS NOT NULL""",
    "fits": "SELECT square_id, regr_slope(y, guess) AS b, regr_intercept(y, guess) AS a, max(y) FILTER (back = 1) AS last, count(*) AS n FROM pairs GROUP BY square_id",
    "ahead": "SELECT square_id, 0 AS step, last AS y FROM fits WHERE n >= 10 UNION ALL SELECT p.square_id, p.step + 1, f.a + f.b * p.y FROM ahead p JOIN fits f ON f.square_id = p.square_id WHERE p.step < 30",
}, recursive=True)
def _(spark, sf):
    df = telemetry(spark, sf).filter(F.col("square_id").isNotNull()).select("square_id", "event_id", "ts", "svr1")
    return r6(fc.arma_forecast(df, ["square_id"], ["ts", "event_id"], "svr1", pdq=(1, 0, 0), steps=30).filter("forecast IS NOT NULL"))


@query("seasonal_ar_forecast", f"""
SELECT h.hour_start + INTERVAL 24 HOUR AS hour_start, CAST(24 - h.back + 1 AS INTEGER) AS step, round(a + b * h.y, 6) AS forecast FROM
  (SELECT *, row_number() OVER (ORDER BY hour_start DESC) AS back FROM ({HOURLY}) t) h,
  (SELECT regr_slope(y, guess) AS b, regr_intercept(y, guess) AS a FROM (SELECT y, lag(y, 24) OVER (ORDER BY hour_start) AS guess FROM ({HOURLY}) t) s) f
WHERE h.back <= 24""", ("telemetry",))
def _(spark, sf):
    return r6(fc.seasonal_arma_forecast(hourly(spark, sf), [], "hour_start", "y", pdq=(0, 0, 0), seasonal=(1, 0, 0)))


@query("seasonal_arma_forecast")
def _(spark, sf):
    return fc.seasonal_arma_forecast(hourly(spark, sf), [], "hour_start", "y")


NUMERIC = ["svr2", "svr3", "svr4", "upload_mbps", "download_mbps", "hour"]


@query("gbt_forecast")
def _(spark, sf):
    train, test = splits(spark, sf)
    out, _, _ = fc.gbt_forecast(train, test, "svr1", NUMERIC, ["square_id"])
    return out.select("event_id", "svr1", "prediction")


@query("feature_importance")
def _(spark, sf):
    train, test = splits(spark, sf)
    _, model, features = fc.gbt_forecast(train, test, "svr1", NUMERIC, ["square_id"])
    return fc.feature_importance(train, model, features)


@query("compare_forecasts")
def _(spark, sf):
    train, test = splits(spark, sf)
    return comparison.compare_forecasts(train, test, ["svr1", "upload_mbps", "download_mbps"], [*NUMERIC, "svr1"], ["square_id"], ["ts", "event_id"])


@query("window_regressor")
def _(spark, sf):
    train, test = splits(spark, sf)
    return fc.window_regressor(train, test, [], ["ts", "event_id"], ["svr1", "upload_mbps", "download_mbps", "hour"], ["svr1", "upload_mbps", "download_mbps"], lookback=5)


@query("window_predictions")
def _(spark, sf):
    train, test = splits(spark, sf)
    return fc.window_predictions(train, test, [], ["ts", "event_id"], ["svr1", "upload_mbps", "download_mbps", "hour"], ["svr1", "upload_mbps", "download_mbps"], lookback=5)


@query("hyperparam_pick")
def _(spark, sf):
    train, test = splits(spark, sf)
    return fc.hyperparam_pick(train, test, [{"lookback": 3}, {"lookback": 5}], keys=[], order=["ts", "event_id"], features=["svr1", "hour"], targets=["svr1"])


# --- comparison -----------------------------------------------------------------------------------------------------------


@query("regression_metrics", """
SELECT square_id, round(avg(abs(svr1 - svr3)), 6) AS mae, round(avg((svr1 - svr3) * (svr1 - svr3)), 6) AS mse, round(sqrt(avg((svr1 - svr3) * (svr1 - svr3))), 6) AS rmse,
  round(CASE WHEN var_pop(svr1) > 0 THEN 1 - avg((svr1 - svr3) * (svr1 - svr3)) / var_pop(svr1) END, 6) AS r2
FROM telemetry WHERE svr3 IS NOT NULL GROUP BY square_id""", ("telemetry",))
def _(spark, sf):
    return r6(fm.regression_metrics(telemetry(spark, sf), ["square_id"], "svr1", "svr3"))


@query("mape", """
SELECT hour, round(avg(abs(svr4 - svr2) / greatest(abs(svr4), pow(2e0, -52))) * 100, 6) AS mape FROM telemetry GROUP BY hour""", ("telemetry",))
def _(spark, sf):
    return r6(fm.mape(telemetry(spark, sf), ["hour"], "svr4", "svr2"))


def best_sql(metric: str, order: str) -> str:
    return f"""SELECT target, 'best_{metric}' AS criterion, model, round({metric}, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY {metric} {order}, model) AS rn FROM results WHERE {metric} IS NOT NULL) t WHERE rn = 1"""


@query("best_model_table", " UNION ALL ".join(best_sql(m, "DESC" if larger else "ASC") for m, larger in fm.COMPARED.items()),
       ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    return r6(fm.best_model_table(results(spark, sf)))


@query("order_models", """
SELECT target, model, row_number() OVER (ORDER BY CASE model WHEN 'XGBoost' THEN 1 WHEN 'ARIMA' THEN 2 ELSE 3 END, model, target) AS position FROM results""",
       ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    from zonalis.plans.slices import Slices

    ordered = fm.order_models(results(spark, sf), ["XGBoost", "ARIMA"]).withColumn("at", F.monotonically_increasing_id())
    return Slices(ordered, [], ["at"], width=1 << 40).numbered("position").select("target", "model", "position")


# --- whole flows ----------------------------------------------------------------------------------------------------------


@query("clean_measurements", f"""
SELECT TRY_CAST(time AS BIGINT) AS time, {num('latitude')} AS latitude, {num('longitude')} AS longitude, send_data AS application_data, square_id FROM raw_text
WHERE NOT coalesce({num('latitude')} IN (0, 99.999, 99.9999, 999, 999.999), false) AND NOT coalesce({num('longitude')} IN (0, 99.999, 99.9999, 999, 999.999), false)""",
       ("raw_text",))
def _(spark, sf):
    return preparation.clean(raw_text(spark, sf)).select("time", "latitude", "longitude", "application_data", "square_id")


FLOWN = ["upload_mbps", "download_mbps"]


@query("impute_flow", f"""
SELECT s.event_id, s.day_id AS date_key, s.is_test, {', '.join(f'round(coalesce(s.{m}, zd.{m}, z.{m}, d.{m}, g.{m}), 6) AS {m}' for m in FLOWN)},
  round(svr1, 6) AS svr1, {', '.join(f'round(coalesce(s.{n}, f_{n}.v), 6) AS {n}' for n in SVR[1:])}
FROM split s LEFT JOIN zd ON s.square_id IS NOT DISTINCT FROM zd.square_id AND s.day_id = zd.day_id
LEFT JOIN z ON s.square_id IS NOT DISTINCT FROM z.square_id LEFT JOIN d ON s.day_id = d.day_id CROSS JOIN g
{' '.join(f'LEFT JOIN ({knn_column(n)}) f_{n} ON s.event_id = f_{n}.event_id' for n in SVR[1:])}""", ("telemetry",), MEDIANS)
def _(spark, sf):
    train, test, _, _ = preparation.impute_flow(telemetry(spark, sf), "event_id", FLOWN)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return r6(both.select("event_id", "date_key", "is_test", *FLOWN, *SVR))


@query("feature_tables")
def _(spark, sf):
    df = telemetry(spark, sf)
    train, test = preparation.impute(df, exclude=["event_id"])
    train, test = preparation.build_features(materialize(train), materialize(test), ["ts", "event_id"])
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.select("event_id", "is_test", *c.FORECASTING_COLUMNS, "zone_avg_latency", "day_avg_latency", "location_hash")


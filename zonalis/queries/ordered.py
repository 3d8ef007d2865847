"""Queries for windows (G), sorting, limits, samples and splits (H), and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.operators import ordering as o
from zonalis.operators import rankings as k
from zonalis.operators import windows as w
from zonalis.operators.aggregates import hourly_resample
from zonalis.plans.adapters import cluster_trials, telemetry
from zonalis.queries.groups import FILLED, SPLIT
from zonalis.queries.registry import query, r6
from zonalis.queries.scalars import ROW_FEATURES

ZONE, ORDER = ["square_id"], ["ts", "event_id"]
OVER_ZONE = "OVER (PARTITION BY square_id ORDER BY ts, event_id)"


@query("lag_features", f"""
SELECT event_id, {', '.join(f'''CASE WHEN square_id IS NOT NULL THEN round(lag({n}) {OVER_ZONE}, 6) END AS {n}_lag1''' for n in w.LAGGED)}
FROM featured""", ("telemetry",), {"featured": ROW_FEATURES})
def _(spark, sf):
    out = w.lag_features(c.row_stats(telemetry(spark, sf)), ZONE, ORDER)
    return r6(out.select("event_id", *[f"{n}_lag1" for n in w.LAGGED]))


@query("ffill_by_group", """
SELECT event_id, CASE WHEN square_id IS NOT NULL THEN last_value(svr2 IGNORE NULLS) OVER z END AS svr2,
  CASE WHEN square_id IS NOT NULL THEN last_value(svr4 IGNORE NULLS) OVER z END AS svr4
FROM telemetry WINDOW z AS (PARTITION BY square_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""", ("telemetry",))
def _(spark, sf):
    return w.ffill_by_group(telemetry(spark, sf), ZONE, ORDER, ["svr2", "svr4"]).select("event_id", "svr2", "svr4")


@query("fill_group_mean", f"""
SELECT event_id, {', '.join(f'round(coalesce({n}, CASE WHEN square_id IS NOT NULL THEN avg({n}) OVER (PARTITION BY square_id) END), 6) AS {n}' for n in FILLED)}
FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return r6(w.fill_group_mean(telemetry(spark, sf), "square_id", FILLED).select("event_id", *FILLED))


@query("interpolate_series", """
SELECT event_id, round(CASE WHEN svr2 IS NOT NULL THEN svr2 WHEN p IS NULL THEN q.v WHEN q IS NULL THEN p.v
  ELSE p.v + (q.v - p.v) * (CAST(n - p.n AS DOUBLE) / (q.n - p.n)) END, 6) AS svr2
FROM (SELECT event_id, svr2, n,
    last_value(CASE WHEN svr2 IS NOT NULL THEN {'n': n, 'v': svr2} END IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
    first_value(CASE WHEN svr2 IS NOT NULL THEN {'n': n, 'v': svr2} END IGNORE NULLS) OVER (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q
  FROM (SELECT event_id, svr2, row_number() OVER (ORDER BY ts, event_id) AS n FROM telemetry) t) x""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).select("event_id", "ts", "svr2")
    return r6(w.interpolate_series(df, [], ORDER, "svr2").select("event_id", "svr2"))


@query("consecutive_diff", """
SELECT event_id, round(date_diff('microsecond', lag(ts) OVER (ORDER BY ts, event_id), ts) / 1e6, 6) AS time_diff_sec FROM events""")
def _(spark, sf):
    return r6(w.consecutive_diff(telemetry(spark, sf).select("event_id", "ts"), ORDER).drop("ts"))


@query("sequence_windows", """
SELECT event_id, label, len(l) AS lookback, round(l[1], 6) AS oldest_svr1, round(l[5], 6) AS newest_svr1, round(list_sum(l), 6) AS sum_svr1,
  m[1] AS oldest_hour
FROM (SELECT event_id, svr3 AS label, list(svr1) OVER z AS l, list(CAST(hour AS DOUBLE)) OVER z AS m FROM telemetry WHERE square_id IS NOT NULL
  WINDOW z AS (PARTITION BY square_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) t WHERE len(l) = 5""", ("telemetry",))
def _(spark, sf):
    out = w.sequence_windows(telemetry(spark, sf), ZONE, ORDER, ["svr1", "hour"], 5, "svr3")
    first = F.transform("window", lambda r: r[0])
    return r6(out.select(
        "event_id", "label", F.size("window").cast("long").alias("lookback"), first[0].alias("oldest_svr1"), first[4].alias("newest_svr1"),
        F.aggregate(first, F.lit(0.0), lambda a, x: a + x).alias("sum_svr1"), F.col("window")[0][1].alias("oldest_hour"),
    ), "oldest_svr1", "newest_svr1", "sum_svr1")


Z_COLUMNS = ["svr1", "svr2", "download_mbps"]
Z_TABLE = f"SELECT event_id, {', '.join(f'round(({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER (), 6) AS {n}_z' for n in Z_COLUMNS)} FROM telemetry"


@query("zscore_outliers", f"""
SELECT event_id, svr1_z, svr2_z, download_mbps_z,
  coalesce(abs(svr1_z) > 3, false) OR coalesce(abs(svr2_z) > 3, false) OR coalesce(abs(download_mbps_z) > 3, false) AS is_outlier
FROM ({Z_TABLE}) t""", ("telemetry",))
def _(spark, sf):
    return r6(w.zscore_outliers(telemetry(spark, sf), Z_COLUMNS).select("event_id", *[f"{n}_z" for n in Z_COLUMNS], "is_outlier"))


NORM = """
SELECT *, (silhouette - min(silhouette) OVER ()) / (max(silhouette) OVER () - min(silhouette) OVER ()) AS silhouette_norm,
  1 - (dbi - min(dbi) OVER ()) / (max(dbi) OVER () - min(dbi) OVER ()) AS dbi_norm,
  (calinski_harabasz - min(calinski_harabasz) OVER ()) / (max(calinski_harabasz) OVER () - min(calinski_harabasz) OVER ()) AS calinski_harabasz_norm
FROM cluster_trials"""


@query("minmax_normalize_metrics", """
SELECT model, param, round(silhouette_norm, 6) AS silhouette_norm, round(dbi_norm, 6) AS dbi_norm,
  round(calinski_harabasz_norm, 6) AS calinski_harabasz_norm FROM norm""", ("cluster_trials",), {"norm": NORM})
def _(spark, sf):
    out = k.minmax_normalize_metrics(cluster_trials(spark, sf), {m: larger for m, (_, larger) in k.SCORE_WEIGHTS.items()})
    return r6(out.select("model", "param", "silhouette_norm", "dbi_norm", "calinski_harabasz_norm"))


@query("rank_models", """
SELECT model, param, round(s, 6) AS combined_score, row_number() OVER (ORDER BY s DESC NULLS LAST, model, param) AS rank
FROM (SELECT *, silhouette_norm * 4e-1 + dbi_norm * 3e-1 + calinski_harabasz_norm * 3e-1 AS s FROM norm) t""", ("cluster_trials",), {"norm": NORM})
def _(spark, sf):
    out = k.rank_models(cluster_trials(spark, sf))
    return r6(out.select("model", "param", "combined_score", F.col("rank").cast("long").alias("rank")), "combined_score")


@query("best_per_group", """
SELECT model, param, silhouette, dbi, calinski_harabasz, n_outliers, n_clusters FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY silhouette DESC, param) AS rn FROM cluster_trials WHERE silhouette IS NOT NULL) t WHERE rn = 1""",
       ("cluster_trials",))
def _(spark, sf):
    return k.best_per_group(cluster_trials(spark, sf), ["model"], "silhouette", True, ["param"])


@query("difference_series", """
SELECT hour_start, round(y - lag(y) OVER t - lag(y, 24) OVER t + lag(y, 25) OVER t, 6) AS y_diff
FROM (SELECT date_trunc('hour', ts) AS hour_start, avg(svr1) AS y FROM telemetry GROUP BY 1) h WINDOW t AS (ORDER BY hour_start)""", ("telemetry",))
def _(spark, sf):
    hourly = hourly_resample(telemetry(spark, sf), ["svr1"]).withColumnRenamed("svr1", "y")
    return r6(w.difference_series(hourly, [], ["hour_start"], "y", d=1, seasonal=1, period=24).select("hour_start", "y_diff"))


@query("rolling_mean", """
SELECT event_id, CASE WHEN square_id IS NOT NULL THEN round(avg(svr2) OVER (PARTITION BY square_id ORDER BY ts, event_id
  ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 6) END AS svr2_mean4 FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return r6(w.rolling_mean(telemetry(spark, sf), ZONE, ORDER, "svr2", 4, "svr2_mean4").select("event_id", "svr2_mean4"))


# --- sorting, limits, samples, splits -----------------------------------------------------------------------------------


@query("sort_chronological", "SELECT event_id, day_id FROM telemetry ORDER BY day_id NULLS LAST, event_id", ("telemetry",))
def _(spark, sf):
    return o.sort_chronological(telemetry(spark, sf).select("event_id", "day_id"), "day_id", ["event_id"])


@query("top_k_by_metric", """
SELECT 'silhouette' AS metric, model, param FROM (SELECT * FROM cluster_trials ORDER BY silhouette DESC NULLS LAST, model, param LIMIT 10) a
UNION ALL SELECT 'dbi', model, param FROM (SELECT * FROM cluster_trials ORDER BY dbi, model, param LIMIT 10) b
UNION ALL SELECT 'calinski_harabasz', model, param FROM (SELECT * FROM cluster_trials ORDER BY calinski_harabasz DESC, model, param LIMIT 10) c""",
       ("cluster_trials",))
def _(spark, sf):
    trials = cluster_trials(spark, sf)
    parts = [k.top_k_by_metric(trials, m, 10, larger).select(F.lit(m).alias("metric"), "model", "param")
             for m, (_, larger) in k.SCORE_WEIGHTS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("most_common", """
SELECT gap, count(*) AS count FROM (SELECT date_diff('second', lag(date_trunc('second', ts)) OVER (ORDER BY ts, event_id), date_trunc('second', ts)) AS gap
FROM events) t WHERE gap IS NOT NULL GROUP BY gap ORDER BY count DESC, gap LIMIT 10""")
def _(spark, sf):
    df = telemetry(spark, sf).select("event_id", "ts")
    df = w.consecutive_diff(df.withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz")), ORDER)
    return o.most_common(df.select(F.col("time_diff_sec").cast("long").alias("gap")), "gap")


@query("sort_trials", """
SELECT model, param, silhouette, row_number() OVER (ORDER BY silhouette DESC NULLS LAST, n_outliers, n_clusters DESC, model, param) AS position
FROM cluster_trials""", ("cluster_trials",))
def _(spark, sf):
    ordered = o.Slices(k.sort_trials(cluster_trials(spark, sf)).withColumn("at", F.monotonically_increasing_id()), [], ["at"], width=1 << 40)
    return ordered.numbered("position").select("model", "param", "silhouette", "position")


@query("sample_fraction")
def _(spark, sf):
    return o.sample_fraction(telemetry(spark, sf), 0.25).select("event_id", "svr1")


@query("sample_fraction_by_hash")
def _(spark, sf):
    return o.sample_fraction_by_hash(telemetry(spark, sf), 0.25, "event_id").select("event_id", "svr1")


@query("sample_n")
def _(spark, sf):
    return o.sample_n(telemetry(spark, sf), 100, "event_id").select("event_id", "svr1")


@query("head_sequential", "SELECT event_id, svr1 FROM telemetry ORDER BY ts, event_id LIMIT 500", ("telemetry",))
def _(spark, sf):
    return o.head_sequential(telemetry(spark, sf), 500, ORDER).select("event_id", "svr1")


@query("split_by_day", "SELECT event_id, is_test FROM split", ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    train, test = o.split_by_day(telemetry(spark, sf).select("event_id", "day_id"))
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))).select("event_id", "is_test")


@query("split_tail", """
SELECT event_id, n > total - CAST(floor(total * 15e-2 + 1e-9) AS BIGINT) AS is_tail
FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS total FROM telemetry) t""", ("telemetry",))
def _(spark, sf):
    return o.split_tail(telemetry(spark, sf).select("event_id", "ts"), [], ORDER, 0.15).select("event_id", "is_tail")


@query("pick_features_cap", """
SELECT * FROM (SELECT 'svr1' AS feature, round(var_samp(svr1), 6) AS variance FROM telemetry UNION ALL SELECT 'svr2', round(var_samp(svr2), 6) FROM telemetry
UNION ALL SELECT 'svr3', round(var_samp(svr3), 6) FROM telemetry UNION ALL SELECT 'upload_mbps', round(var_samp(upload_mbps), 6) FROM telemetry
UNION ALL SELECT 'download_mbps', round(var_samp(download_mbps), 6) FROM telemetry) t ORDER BY variance DESC LIMIT 3""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).select("svr1", "svr2", "svr3", "upload_mbps", "download_mbps")
    names = o.pick_features_cap(df, 3, by_variance=True)
    return r6(o.feature_variances(df, names))

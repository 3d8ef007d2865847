"""Queries for joins of statistics (E), aggregations (F), sets (I) and quality reports (J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions import predicates as p
from zonalis.operators import aggregates as a
from zonalis.operators import imputation, joins, quality, sets
from zonalis.operators.ordering import split_by_day
from zonalis.plans.adapters import raw_text, read, telemetry, vectors
from zonalis.queries.registry import NUDGE, query, r6
from zonalis.queries.results import results
from zonalis.queries.scalars import RESULTS, ROW_FEATURES, num

FILLED = ["svr2", "svr3", "svr4", "upload_mbps", "download_mbps"]
SPLIT = """
SELECT t.*, t.day_id >= (SELECT min(day_id) FROM (SELECT day_id, row_number() OVER (ORDER BY day_id DESC) AS back
  FROM (SELECT DISTINCT day_id FROM telemetry) u) d WHERE back <= greatest(1, round_even(2e-1 * (SELECT count(DISTINCT day_id) FROM telemetry), 0))) AS is_test
FROM telemetry t"""
ZONE_RAW = """
SELECT square_id, count(*) AS n, list_filter([avg(svr1), avg(svr2), avg(svr3), avg(svr4)], lambda x : x IS NOT NULL) AS la,
  list_filter([stddev_samp(svr1), stddev_samp(svr2), stddev_samp(svr3), stddev_samp(svr4)], lambda x : x IS NOT NULL) AS ls,
  avg(upload_mbps) AS u, avg(download_mbps) AS d, avg(latitude) AS lat, avg(longitude) AS lon
FROM split WHERE NOT is_test AND square_id IS NOT NULL GROUP BY square_id"""
ZONES = """
SELECT square_id, CAST(n AS DOUBLE) AS zone_record_count, coalesce(l, avg(l) OVER ()) AS zone_avg_latency, coalesce(s, avg(s) OVER ()) AS zone_std_latency,
  coalesce(u, avg(u) OVER ()) AS zone_avg_upload, coalesce(d, avg(d) OVER ()) AS zone_avg_download,
  coalesce(lat, avg(lat) OVER ()) AS zone_center_lat, coalesce(lon, avg(lon) OVER ()) AS zone_center_lon
FROM (SELECT *, list_avg(la) AS l, list_avg(ls) AS s FROM zone_raw) z"""
ZONE_FIGURES = ["zone_record_count", "zone_avg_latency", "zone_std_latency", "zone_avg_upload", "zone_avg_download", "zone_center_lat", "zone_center_lon"]
DAY_FIGURES = ["day_record_count", "day_avg_latency", "day_std_latency", "day_avg_upload", "day_avg_download"]
DAY_RAW = ZONE_RAW.replace("square_id", "day_id")
DAYS = """
SELECT day_id, CAST(n AS DOUBLE) AS day_record_count, coalesce(l, avg(l) OVER ()) AS day_avg_latency, coalesce(s, avg(s) OVER ()) AS day_std_latency,
  coalesce(u, avg(u) OVER ()) AS day_avg_upload, coalesce(d, avg(d) OVER ()) AS day_avg_download
FROM (SELECT *, list_avg(la) AS l, list_avg(ls) AS s FROM zone_raw) z"""


def rounds(names: list[str], alias: str = "") -> str:
    return ", ".join(f"round({alias}{n} + {NUDGE}, 6) AS {n}" for n in names)


def medians_sql(keys: str) -> str:
    return f"SELECT {keys}, " + ", ".join(f"median({m}) AS {m}" for m in FILLED) + f" FROM split WHERE NOT is_test GROUP BY {keys}"


MEDIANS = {"split": SPLIT, "zd": medians_sql("square_id, day_id"), "z": medians_sql("square_id"), "d": medians_sql("day_id"),
           "g": medians_sql("true")}


def splits(spark, sf):
    return split_by_day(telemetry(spark, sf))


@query("group_medians", " UNION ALL ".join(
    f"SELECT '{level}' AS level, {zone} AS square_id, {day} AS day_id, {rounds(FILLED)} FROM {t}" for level, zone, day, t in
    [("zone_day", "square_id", "day_id", "zd"), ("zone", "square_id", "NULL", "z"), ("day", "NULL", "day_id", "d"), ("global", "NULL", "NULL", "g")]
), ("telemetry",), MEDIANS)
def _(spark, sf):
    train, _ = splits(spark, sf)
    levels = imputation.group_medians(train, FILLED)
    return r6(sets.union_by_name(*[t.withColumn("level", F.lit(n)) for n, t in levels.items()]).select("level", "square_id", "day_id", *FILLED), nudge=NUDGE)


@query("fill_from_level", f"""
SELECT s.event_id, {', '.join(f'round(coalesce(s.{m}, zd.{m}), 6) AS {m}' for m in FILLED)}
FROM split s LEFT JOIN zd ON s.square_id IS NOT DISTINCT FROM zd.square_id AND s.day_id IS NOT DISTINCT FROM zd.day_id
WHERE NOT is_test""", ("telemetry",), {"split": SPLIT, "zd": MEDIANS["zd"]})
def _(spark, sf):
    train, _ = splits(spark, sf)
    keys = ["square_id", "day_id"]
    medians = imputation.medians_by(train, keys, FILLED)
    return r6(imputation.fill_from_level(train, keys, medians, FILLED).select("event_id", *FILLED))


@query("hierarchical_impute", f"""
SELECT s.event_id, s.is_test, {', '.join(f'round(coalesce(s.{m}, zd.{m}, z.{m}, d.{m}, g.{m}), 6) AS {m}' for m in FILLED)}
FROM split s LEFT JOIN zd ON s.square_id IS NOT DISTINCT FROM zd.square_id AND s.day_id = zd.day_id
LEFT JOIN z ON s.square_id IS NOT DISTINCT FROM z.square_id LEFT JOIN d ON s.day_id = d.day_id CROSS JOIN g""", ("telemetry",), MEDIANS)
def _(spark, sf):
    train, test = imputation.hierarchical_impute(*splits(spark, sf), FILLED)
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return r6(both.select("event_id", "is_test", *FILLED))


@query("zone_stats", f"SELECT square_id, {rounds(ZONE_FIGURES)} FROM zones", ("telemetry",), {"split": SPLIT, "zone_raw": ZONE_RAW, "zones": ZONES})
def _(spark, sf):
    return r6(a.zone_stats(splits(spark, sf)[0]).select("square_id", F.col("zone_record_count").cast("double").alias("zone_record_count"), *ZONE_FIGURES[1:]), nudge=NUDGE)


@query("day_stats", f"SELECT day_id, {rounds(DAY_FIGURES)} FROM days", ("telemetry",), {"split": SPLIT, "zone_raw": DAY_RAW, "days": DAYS})
def _(spark, sf):
    return r6(a.day_stats(splits(spark, sf)[0]).select("day_id", F.col("day_record_count").cast("double").alias("day_record_count"), *DAY_FIGURES[1:]), nudge=NUDGE)


def attached(key: str, table: str, names: list[str]) -> str:
    means = ", ".join(f"avg({n}) AS {n}" for n in names)
    figures = ", ".join(f"round(CASE WHEN j.is_test THEN coalesce(j.{n}, m.{n}) ELSE j.{n} END + {NUDGE}, 6) AS {n}" for n in names)
    return f"""
SELECT j.event_id, j.is_test, {figures}
FROM (SELECT s.event_id, s.is_test, {', '.join('t.' + n for n in names)} FROM split s LEFT JOIN {table} t ON s.{key} = t.{key}) j
CROSS JOIN (SELECT {means} FROM split s JOIN {table} t ON s.{key} = t.{key} WHERE NOT s.is_test) m"""


def both_splits(train, test, names):
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return r6(both.select("event_id", "is_test", *[F.col(n).cast("double").alias(n) for n in names]), nudge=NUDGE)


@query("attach_zone_stats", attached("square_id", "zones", ZONE_FIGURES), ("telemetry",), {"split": SPLIT, "zone_raw": ZONE_RAW, "zones": ZONES})
def _(spark, sf):
    return both_splits(*joins.attach_zone_stats(*splits(spark, sf)), ZONE_FIGURES)


@query("attach_day_stats", attached("day_id", "days", DAY_FIGURES), ("telemetry",), {"split": SPLIT, "zone_raw": DAY_RAW, "days": DAYS})
def _(spark, sf):
    return both_splits(*joins.attach_day_stats(*splits(spark, sf)), DAY_FIGURES)


@query("fill_test_with_train_mean", f"""
SELECT s.event_id, {', '.join(f'round(coalesce(s.{n}, m.{n}), 6) AS {n}' for n in FILLED)}
FROM split s CROSS JOIN (SELECT {', '.join(f'avg({n}) AS {n}' for n in FILLED)} FROM split WHERE NOT is_test) m WHERE s.is_test""",
       ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    return r6(imputation.fill_test_with_train_mean(*splits(spark, sf), FILLED).select("event_id", *FILLED))


@query("join_labels_on_point", """
SELECT t.event_id, l.cluster FROM telemetry t LEFT JOIN (
  SELECT latitude, longitude, CAST(floor(min(svr1)) AS BIGINT) % 5 AS cluster FROM telemetry GROUP BY latitude, longitude) l
ON t.latitude = l.latitude AND t.longitude = l.longitude""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf)
    labels = df.groupBy("latitude", "longitude").agg((F.floor(F.min("svr1")).cast("long") % 5).alias("cluster"))
    return joins.join_labels_on_point(df, labels).select("event_id", "cluster")


ROLLUP = ["latitude", "longitude", "avg_latency", "std_latency", "total_throughput"]
FIRST = ["zone_avg_latency", "zone_avg_upload", "zone_avg_download"]


@query("zone_rollup", f"""
SELECT f.square_id, {', '.join(f'round(avg({n}) + {NUDGE}, 6) AS {n}' for n in ROLLUP)}, {', '.join(f'round(min(z.{n}) + {NUDGE}, 6) AS {n}' for n in FIRST)}
FROM featured f JOIN zones z ON f.square_id = z.square_id WHERE NOT f.is_test GROUP BY f.square_id""", ("telemetry",),
       {"split": SPLIT, "zone_raw": ZONE_RAW, "zones": ZONES, "featured": ROW_FEATURES.replace("FROM telemetry", "FROM split")})
def _(spark, sf):
    train, _ = joins.attach_zone_stats(*splits(spark, sf))
    return r6(a.zone_rollup(c.throughput_features(c.row_stats(train))), nudge=NUDGE)


@query("bbox_stats", """
SELECT square_id, count(*) AS count, min(latitude) AS lat_min, max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max,
  round(avg(latitude) + 3e-9, 6) AS lat_mean, round(avg(longitude) + 3e-9, 6) AS lon_mean
FROM telemetry WHERE square_id IS NOT NULL AND latitude <> 999 GROUP BY square_id""", ("telemetry",))
def _(spark, sf):
    return r6(a.bbox_stats(p.drop_invalid_gps(telemetry(spark, sf))), "lat_mean", "lon_mean", nudge=NUDGE)


@query("time_coverage", "SELECT min(ts) AS time_min, max(ts) AS time_max FROM events")
def _(spark, sf):
    return a.time_coverage(telemetry(spark, sf))


@query("value_counts", """
SELECT 'date' AS part, CAST(CAST(ts AS DATE) AS VARCHAR) AS value, count(*) AS count FROM events GROUP BY ALL
UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'day_name', dayname(ts), count(*) FROM events GROUP BY ALL""")
def _(spark, sf):
    df = c.calendar_parts(telemetry(spark, sf), "ts")
    return sets.union_by_name(*[
        a.value_counts(df, F.col(n).cast("string"), "value").withColumn("part", F.lit(n)) for n in ("date", "hour", "day_name")
    ]).select("part", "value", "count")


@query("describe_column", """
SELECT count(svr2) AS count, round(avg(svr2), 6) AS mean, round(stddev_samp(svr2), 6) AS std, min(svr2) AS min, max(svr2) AS max,
  round(quantile_cont(svr2, 0.25), 6) AS p25, round(quantile_cont(svr2, 0.5), 6) AS p50, round(quantile_cont(svr2, 0.75), 6) AS p75
FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return r6(a.describe_column(telemetry(spark, sf), "svr2"), "mean", "std", "p25", "p50", "p75")


@query("daily_summary", """
SELECT day_id, count(*) AS records, round((avg(svr1) + avg(svr2) + avg(svr3) + avg(svr4)) / 4, 6) AS mean_latency,
  round((avg(upload_mbps) + avg(download_mbps)) / 2, 6) AS mean_throughput FROM telemetry GROUP BY day_id""", ("telemetry",))
def _(spark, sf):
    return r6(a.daily_summary(telemetry(spark, sf)))


@query("hourly_resample", """
SELECT date_trunc('hour', ts) AS hour_start, round(avg(svr1), 6) AS svr1, round(avg(svr4), 6) AS svr4, round(avg(upload_mbps), 6) AS upload_mbps
FROM telemetry GROUP BY 1 HAVING avg(svr1) IS NOT NULL OR avg(svr4) IS NOT NULL OR avg(upload_mbps) IS NOT NULL""", ("telemetry",))
def _(spark, sf):
    return r6(a.hourly_resample(telemetry(spark, sf), ["svr1", "svr4", "upload_mbps"]))


@query("cluster_profile", """
SELECT label AS cluster, round_even(avg(embedding[1]) * 1e2, 0) / 1e2 AS f0, round_even(avg(embedding[2]) * 1e2, 0) / 1e2 AS f1
FROM (SELECT label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings) e GROUP BY label""")
def _(spark, sf):
    df = vectors(spark, sf).select(F.col("label").alias("cluster"), F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1"))
    return a.cluster_profile(df, ["f0", "f1"])


@query("fill_remaining", f"""
SELECT event_id, {', '.join(f'round(coalesce({n}, (SELECT median({n}) FROM telemetry)), 6) AS {n}' for n in FILLED)},
  coalesce(square_id, (SELECT square_id FROM telemetry WHERE square_id IS NOT NULL GROUP BY square_id ORDER BY count(*) DESC, square_id LIMIT 1)) AS square_id
FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return r6(imputation.fill_remaining(telemetry(spark, sf), FILLED, ["square_id"]).select("event_id", *FILLED, "square_id"))


@query("cluster_counts", """
SELECT count(DISTINCT label) FILTER (label > 0) AS n_clusters, count(*) FILTER (label = 0) AS n_outliers,
  round(count(*) FILTER (label = 0) * 1e2 / count(*), 6) AS outlier_pct FROM embeddings""")
def _(spark, sf):
    return r6(a.cluster_counts(vectors(spark, sf).withColumn("label", F.col("label") - 1)))


@query("cluster_sizes", "SELECT label, count(*) AS size FROM embeddings GROUP BY label")
def _(spark, sf):
    return a.cluster_sizes(vectors(spark, sf))


MODELS = ["GRU", "XGBoost", "ARIMA", "Prophet", "SRNN"]


@query("metric_matrix", f"SELECT target, {', '.join(f'''max(mae) FILTER (model = '{m}') AS {m}''' for m in MODELS)} FROM results GROUP BY target",
       ("model_results_raw",), {"results": RESULTS})
def _(spark, sf):
    return a.metric_matrix(results(spark, sf), "mae", MODELS)


@query("distinct_count", """
SELECT count(DISTINCT square_id) AS square_id_distinct, count(DISTINCT day_id) AS day_id_distinct, count(DISTINCT hour) AS hour_distinct
FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return a.distinct_count(telemetry(spark, sf), ["square_id", "day_id", "hour"])


# --- sets -----------------------------------------------------------------------------------------------------------


@query("union_by_name", """
SELECT event_id, svr1, NULL AS svr2, square_id FROM telemetry WHERE square_id IS NOT NULL
UNION ALL SELECT event_id, NULL, svr2, NULL FROM telemetry WHERE square_id IS NULL""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf)
    known, unknown = p.split_known_unknown(df)
    return sets.union_by_name(known.select("event_id", "svr1", "square_id"), unknown.select("event_id", "svr2"))


@query("drop_exact_duplicates", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def _(spark, sf):
    return sets.drop_exact_duplicates(spark.read.parquet(f"{sf}/documents.parquet").drop("doc_id"))


@query("duplicate_report", """
SELECT day_id, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT day_id, hour, square_id, count(*) AS n FROM telemetry GROUP BY ALL) g GROUP BY day_id
UNION ALL SELECT NULL, CAST(sum(n - 1) AS BIGINT) FROM (SELECT day_id, hour, square_id, count(*) AS n FROM telemetry GROUP BY ALL) g""", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).select("day_id", "hour", "square_id")
    return sets.union_by_name(sets.duplicate_report(df, "day_id"), sets.duplicate_report(df))


# --- quality --------------------------------------------------------------------------------------------------------


def per_day_and_total(report, df, *args):
    return sets.union_by_name(report(df, *args, day="day_id"), report(df, *args))


@query("invalid_gps_report", """
SELECT day_id, count(*) FILTER (latitude > 90) AS invalid_gps FROM telemetry GROUP BY day_id
UNION ALL SELECT NULL, count(*) FILTER (latitude > 90) FROM telemetry""", ("telemetry",))
def _(spark, sf):
    return per_day_and_total(quality.invalid_gps_report, telemetry(spark, sf))


NEGATIVE = """count(*) FILTER (svr1 - 2 < 0) + count(*) FILTER (svr2 < 0) + count(*) FILTER (svr3 < 0) + count(*) FILTER (svr4 < 0) AS negative_latency,
  count(*) FILTER (upload_mbps - 1 < 0) + count(*) FILTER (download_mbps < 0) AS negative_throughput FROM telemetry"""


@query("negative_value_report", f"SELECT day_id, {NEGATIVE} GROUP BY day_id UNION ALL SELECT NULL, {NEGATIVE}", ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).withColumns({"svr1": F.col("svr1") - 2, "upload_mbps": F.col("upload_mbps") - 1})
    return per_day_and_total(quality.negative_value_report, df)


COLUMNS = ["square_id", "latitude", "svr1", "svr2", "svr3", "svr4", "upload_mbps", "download_mbps"]


@query("missing_report", " UNION ALL ".join(f"SELECT '{n}' AS column_name, count(*) FILTER ({n} IS NULL) AS null_count FROM telemetry" for n in COLUMNS), ("telemetry",))
def _(spark, sf):
    return quality.missing_report(telemetry(spark, sf), COLUMNS)


TYPED = ["transfer_size", "bitrate", "month", "time"]


@query("type_report", " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count(*) FILTER ({n} IS NOT NULL AND ({num(n)}) IS NULL) AS not_numeric FROM raw_text" for n in TYPED), ("raw_text",))
def _(spark, sf):
    return quality.type_report(raw_text(spark, sf), TYPED)


@query("constant_column_report", """
SELECT * FROM (SELECT 'svr1' AS column_name, count(DISTINCT svr1) AS n FROM telemetry UNION ALL SELECT 'month', count(DISTINCT month(ts)) FROM telemetry
UNION ALL SELECT 'hour', count(DISTINCT hour) FROM telemetry) x WHERE n <= 1""".replace("SELECT *", "SELECT column_name", 1), ("telemetry",))
def _(spark, sf):
    df = telemetry(spark, sf).withColumn("month", F.month("ts"))
    return quality.constant_column_report(df, ["svr1", "month", "hour"])


def z(n: str, over: str) -> str:
    return f"abs(({n} - avg({n}) OVER ({over})) / nullif(stddev_pop({n}) OVER ({over}), 0)) > 3"


def flagged(over: str) -> str:
    tests = " OR ".join(f"coalesce({z(n, over)}, false)" for n in ("svr1", "svr2", "download_mbps"))
    return f"(SELECT event_id, day_id, {tests} AS is_outlier FROM telemetry) f"


@query("outlier_report", f"""
SELECT day_id, count(*) FILTER (is_outlier) AS outliers FROM {flagged('PARTITION BY day_id')} GROUP BY day_id
UNION ALL SELECT NULL, count(*) FILTER (is_outlier) FROM {flagged('')}""", ("telemetry",))
def _(spark, sf):
    return per_day_and_total(quality.outlier_report, telemetry(spark, sf), ["svr1", "svr2", "download_mbps"])


# --- large groups of another table ------------------------------------------------------------------------------------


@query("ship_day_medians", """
SELECT l_shipdate AS day_id, count(*) AS records, round(median(CAST(l_quantity AS DOUBLE)), 6) AS median_quantity,
  round(median(CAST(l_extendedprice AS DOUBLE)), 6) AS median_price FROM lineitem GROUP BY l_shipdate""")
def _(spark, sf):
    df = read(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("day_id"), F.col("l_quantity").cast("double").alias("quantity"), F.col("l_extendedprice").cast("double").alias("price")
    )
    medians = imputation.medians_by(df, ["day_id"], ["quantity", "price"])
    counts = df.groupBy("day_id").agg(F.count(F.lit(1)).alias("records"))
    out = counts.join(medians, "day_id").withColumnsRenamed({"quantity": "median_quantity", "price": "median_price"})
    return r6(out)

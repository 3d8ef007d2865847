"""Queries for spatial and neighbour joins (E), encoding (K), clustering (L) and cluster quality (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions import predicates as p
from zonalis.operators import aggregates as a
from zonalis.operators import cluster_metrics as m
from zonalis.operators import clustering as cl
from zonalis.operators import encoding as e
from zonalis.operators import joins, neighbours, spatial
from zonalis.operators.ordering import split_by_day
from zonalis.plans import comparison
from zonalis.plans.adapters import telemetry, vectors
from zonalis.plans.materialize import materialize
from zonalis.queries.groups import FILLED, SPLIT, ZONE_RAW, ZONES, splits
from zonalis.queries.registry import BODIES, query, r6
from zonalis.queries.scalars import ROW_FEATURES

VALID = "SELECT * FROM telemetry WHERE latitude <> 999"


def valid(spark, sf):
    return p.drop_invalid_gps(telemetry(spark, sf))


@query("assign_by_bbox", """
SELECT u.event_id, min_by(b.square_id, (b.area, b.square_id)) AS bbox_zone FROM valid u LEFT JOIN (
  SELECT square_id, min(latitude) AS a, max(latitude) AS b, min(longitude) AS c, max(longitude) AS d,
    (max(latitude) - min(latitude)) * (max(longitude) - min(longitude)) AS area FROM valid WHERE square_id IS NOT NULL GROUP BY square_id) b
  ON u.latitude BETWEEN b.a AND b.b AND u.longitude BETWEEN b.c AND b.d
WHERE u.square_id IS NULL GROUP BY u.event_id""", ("telemetry",), {"valid": VALID})
def _(spark, sf):
    known, unknown = p.split_known_unknown(valid(spark, sf))
    return spatial.assign_by_bbox(unknown, a.bbox_stats(known)).select("event_id", "bbox_zone")


@query("knn_haversine_classify", """
SELECT event_id, CASE WHEN round(best / total, 9) >= 0.6 THEN zone END AS knn_zone, round(best / total, 6) AS share FROM (
  SELECT event_id, min_by(zone, (-vote, zone)) AS zone, max(vote) AS best, sum(vote) AS total FROM (
    SELECT event_id, zone, sum(CASE WHEN zero THEN CAST(d = 0 AS DOUBLE) ELSE 1 / nullif(d, 0) END) AS vote FROM (
      SELECT *, min(d) OVER (PARTITION BY event_id) = 0 AS zero FROM (
        SELECT u.event_id, k.square_id AS zone, round(2 * asin(sqrt(
            pow(sin((radians(k.latitude) - radians(u.latitude)) / 2), 2)
            + cos(radians(u.latitude)) * cos(radians(k.latitude)) * pow(sin((radians(k.longitude) - radians(u.longitude)) / 2), 2))), 12) AS d
        FROM valid u CROSS JOIN valid k WHERE u.square_id IS NULL AND k.square_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY u.event_id ORDER BY d, k.square_id) <= 7) n) z
    GROUP BY event_id, zone) v
  GROUP BY event_id) b""", ("telemetry",), {"valid": VALID})
def _(spark, sf):
    known, unknown = p.split_known_unknown(valid(spark, sf))
    return r6(neighbours.knn_haversine_classify(known, unknown, "event_id"))


@query("impute_unknown_zones", """
SELECT v.event_id, coalesce(v.square_id, b.bbox_zone, k.knn_zone, 'Unknown') AS square_id
FROM valid v LEFT JOIN boxed b ON v.event_id = b.event_id LEFT JOIN voted k ON v.event_id = k.event_id""",
       ("telemetry",), {"valid": VALID, "boxed": BODIES["assign_by_bbox"], "voted": BODIES["knn_haversine_classify"]})
def _(spark, sf):
    return spatial.impute_unknown_zones(valid(spark, sf), "event_id").select("event_id", "square_id")


DISTANCE = "round(sqrt(list_sum(list_transform(list_zip(x.f, y.f), lambda z : (z[1] - z[2]) * (z[1] - z[2])))), 9)"
POINTS = "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f, CAST(label AS BIGINT) AS label FROM embeddings"
PAIRS = f"SELECT x.id, y.id AS other, x.label AS own, y.label, {DISTANCE} AS d FROM pts x CROSS JOIN pts y"
VEC = {"pts": POINTS, "pairs": PAIRS}


def vec(spark, sf):
    return vectors(spark, sf).select(F.col("vec_id").alias("id"), "features", F.col("label").cast("long").alias("label"))


@query("knn_join", """
SELECT id, other, round(d, 6) AS distance, row_number() OVER (PARTITION BY id ORDER BY d, other) AS neighbour FROM pairs WHERE id <> other
QUALIFY neighbour <= 5""", (), VEC)
def _(spark, sf):
    df = vec(spark, sf)
    return r6(neighbours.knn_join(df, df, 5, skip_self=True).withColumn("neighbour", F.col("neighbour").cast("long")))


@query("core_distance", """
SELECT id, round(d, 6) AS core FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d, other) AS n FROM pairs) t WHERE n = 5""", (), VEC)
def _(spark, sf):
    return r6(neighbours.core_distance(vec(spark, sf), 5))


@query("mutual_reachability", """
SELECT e.id, e.other, round(greatest(a.core, b.core, e.d), 6) AS weight
FROM (SELECT * FROM pairs WHERE id <> other QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, other) <= 5) e
JOIN core a ON e.id = a.id JOIN core b ON e.other = b.id""", (), VEC | {
    "core": "SELECT id, d AS core FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d, other) AS n FROM pairs) t WHERE n = 5"})
def _(spark, sf):
    return r6(neighbours.mutual_reachability(vec(spark, sf), 5, 5))


@query("assign_to_clusters", f"""
SELECT id, min_by(label, (-n, label)) AS label FROM (
  SELECT id, label, count(*) AS n FROM (
    SELECT x.id, y.label, {DISTANCE} AS d, y.id AS other FROM moved x CROSS JOIN (SELECT id, f, label - 1 AS label FROM pts WHERE label <> 0) y
    QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY d, other) <= 5) k
  GROUP BY id, label) v GROUP BY id""", (), {"pts": POINTS, "moved": "SELECT id, list_transform(f, lambda z : z + 5e-2) AS f FROM pts"})
def _(spark, sf):
    df = vec(spark, sf)
    test = df.select("id", F.transform("features", lambda x: x + 0.05).alias("features"))
    return neighbours.assign_to_clusters(df.withColumn("label", F.col("label") - 1), test, k=5)


SVR = ["svr1", "svr2", "svr3", "svr4"]


def knn_column(n: str) -> str:
    def gap(x: str) -> str:
        return f"coalesce((t.{x} - d.{x}) * (t.{x} - d.{x}), 0)"
    common = " + ".join(f"CAST(t.{x} IS NOT NULL AND d.{x} IS NOT NULL AS INT)" for x in SVR)
    distance = f"round(sqrt(4 * ({' + '.join(gap(x) for x in SVR)}) / ({common})), 9)"
    return f"""SELECT event_id, avg(v) AS v FROM (SELECT t.event_id, d.{n} AS v FROM split t JOIN split d ON t.{n} IS NULL AND d.{n} IS NOT NULL AND NOT d.is_test
  QUALIFY row_number() OVER (PARTITION BY t.event_id ORDER BY {distance}, d.event_id) <= 5) x GROUP BY event_id"""


@query("knn_impute", f"""
SELECT s.event_id, svr1, {', '.join(f'round(coalesce(s.{n}, f_{n}.v), 6) AS {n}' for n in SVR[1:])}
FROM split s {' '.join(f'LEFT JOIN ({knn_column(n)}) f_{n} ON s.event_id = f_{n}.event_id' for n in SVR[1:])}""", ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    df = telemetry(spark, sf)
    train, _ = split_by_day(df)
    return r6(neighbours.knn_impute(train, df, "event_id", SVR).select("event_id", *SVR), *SVR[1:])


# --- encoding, scaling, selection ---------------------------------------------------------------------------------------


@query("encode_categories", """
SELECT event_id, is_test, CASE WHEN square_id IS NULL THEN -1 ELSE CAST(dense_rank() OVER (ORDER BY square_id NULLS LAST) - 1 AS BIGINT) END AS square_id_code
FROM split""", ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    train, test = e.encode_categories(*splits(spark, sf), ["square_id"])
    both = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    return both.select("event_id", "is_test", "square_id_code")


def scaled_sql(shift: str, divisor: str) -> str:
    parts = ", ".join(f"round((s.{n} - (SELECT {shift.format(n)} FROM split WHERE NOT is_test)) / (SELECT {divisor.format(n)} FROM split WHERE NOT is_test), 6) AS {n}" for n in FILLED)
    return f"SELECT event_id, {parts} FROM split s"


@query("standard_scale", scaled_sql("avg({0})", "stddev_pop({0})"), ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    train, test = e.standard_scale(*splits(spark, sf), FILLED)
    return r6(train.unionByName(test).select("event_id", *FILLED))


@query("minmax_scale", scaled_sql("min({0})", "(max({0}) - min({0}))"), ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    train, test = e.minmax_scale(*splits(spark, sf), FILLED)
    return r6(train.unionByName(test).select("event_id", *FILLED))


@query("impute_feature_median", f"""
SELECT event_id, {', '.join(f'round(coalesce({n}, (SELECT median({n}) FROM split WHERE NOT is_test)), 6) AS {n}' for n in FILLED)} FROM split""",
       ("telemetry",), {"split": SPLIT})
def _(spark, sf):
    train, test = e.impute_feature_median(*splits(spark, sf), FILLED)
    return r6(train.unionByName(test).select("event_id", *FILLED))


@query("align_target", "SELECT event_id, svr4 FROM telemetry WHERE svr4 IS NOT NULL", ("telemetry",))
def _(spark, sf):
    return e.align_target(telemetry(spark, sf), "svr4").select("event_id", "svr4")


CANDIDATES = ["svr1", "svr2", "svr4", "upload_mbps", "hour"]


@query("select_f_regression", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, round(r * r * (n - 2) / (1 - r * r), 3) AS f_value FROM (SELECT corr({n}, svr3) AS r, count(*) FILTER ({n} IS NOT NULL AND svr3 IS NOT NULL) AS n FROM telemetry) x"
    for n in CANDIDATES) + ") t ORDER BY f_value DESC LIMIT 3", ("telemetry",))
def _(spark, sf):
    return r6(e.select_f_regression(telemetry(spark, sf), CANDIDATES, "svr3", 3), places=3)


def bin_sql(n: str) -> str:
    return " + ".join(f"CAST({n} > (SELECT quantile_cont({n}, {i / 8}) FROM telemetry) AS INT)" for i in range(1, 8))


def mi_sql(n: str) -> str:
    return f"""SELECT '{n}' AS feature, round(sum(n / nt * ln(n * nt / (nx * ny))), 6) AS mutual_info FROM (
  SELECT CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS nt FROM (
    SELECT {bin_sql(n)} AS x, {bin_sql('svr3')} AS y, count(*) AS n FROM telemetry WHERE {n} IS NOT NULL AND svr3 IS NOT NULL GROUP BY 1, 2) j) t"""


@query("select_mutual_info", "SELECT * FROM (" + " UNION ALL ".join(mi_sql(n) for n in CANDIDATES) + ") t ORDER BY mutual_info DESC LIMIT 3", ("telemetry",))
def _(spark, sf):
    return r6(e.select_mutual_info(telemetry(spark, sf), CANDIDATES, "svr3", 3, bins=8))


@query("select_rf_importance")
def _(spark, sf):
    return e.select_rf_importance(telemetry(spark, sf), CANDIDATES, "svr3", 3, trees=100)


@query("pca_2d")
def _(spark, sf):
    df = c.row_stats(telemetry(spark, sf)).na.drop(subset=["svr1", "avg_latency", "upload_mbps", "download_mbps"])
    return e.pca_2d(df.select("event_id", "svr1", "avg_latency", "upload_mbps", "download_mbps"), ["svr1", "avg_latency", "upload_mbps", "download_mbps"])


# --- cluster quality ----------------------------------------------------------------------------------------------------

SILHOUETTE = """
SELECT id, label, CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM (
  SELECT id, own AS label, max(n) FILTER (own = label) AS size, max(total / nullif(n - 1, 0)) FILTER (own = label) AS a,
    min(total / n) FILTER (own <> label) AS b
  FROM (SELECT id, own, label, sum(d) AS total, count(*) AS n FROM pairs GROUP BY ALL) s GROUP BY id, own) t"""
CENTRES = "SELECT label, i, avg(f[i]) AS m, count(*) AS n FROM pts, range(1, 65) r(i) GROUP BY label, i"
SPREADS = """SELECT p.label, avg(d) AS spread FROM (SELECT p.id, p.label, sqrt(sum((p.f[c.i] - c.m) * (p.f[c.i] - c.m))) AS d
  FROM pts p JOIN centres c ON p.label = c.label GROUP BY p.id, p.label) p GROUP BY p.label"""


@query("silhouette", "SELECT round(avg(silhouette), 6) AS silhouette FROM samples", (), VEC | {"samples": SILHOUETTE})
def _(spark, sf):
    return r6(m.silhouette(vec(spark, sf)))


@query("silhouette_samples", "SELECT id, label, round(silhouette, 6) AS silhouette, silhouette < -0.1 AS is_outlier FROM samples", (), VEC | {"samples": SILHOUETTE})
def _(spark, sf):
    return r6(m.flag_silhouette_outliers(vec(spark, sf)))


@query("silhouette_squared", "SELECT round(avg(silhouette), 6) AS silhouette FROM samples", (), VEC | {"samples": SILHOUETTE.replace("sum(d)", "sum(d * d)")})
def _(spark, sf):
    return r6(m.silhouette(vec(spark, sf), approx=True))


@query("davies_bouldin", """
SELECT round(avg(worst), 6) AS davies_bouldin FROM (
  SELECT a.label, max((a.spread + b.spread) / d) AS worst FROM (
    SELECT x.label AS la, y.label AS lb, sqrt(sum((x.m - y.m) * (x.m - y.m))) AS d FROM centres x JOIN centres y ON x.i = y.i AND x.label <> y.label GROUP BY 1, 2) g
  JOIN spreads a ON a.label = la JOIN spreads b ON b.label = lb GROUP BY a.label) t""", (), {"pts": POINTS, "centres": CENTRES, "spreads": SPREADS})
def _(spark, sf):
    return r6(m.davies_bouldin(vec(spark, sf)))


@query("calinski_harabasz", """
SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM
  (SELECT sum(c.n * (c.m - g.m) * (c.m - g.m)) AS b, count(DISTINCT c.label) AS k FROM centres c JOIN (SELECT i, avg(f[i]) AS m FROM pts, range(1, 65) r(i) GROUP BY i) g ON c.i = g.i) bt,
  (SELECT sum((p.f[c.i] - c.m) * (p.f[c.i] - c.m)) AS w, count(DISTINCT p.id) AS n FROM pts p JOIN centres c ON p.label = c.label) wt""",
       (), {"pts": POINTS, "centres": CENTRES})
def _(spark, sf):
    return r6(m.calinski_harabasz(vec(spark, sf)))


@query("inertia", "SELECT round(sum((p.f[c.i] - c.m) * (p.f[c.i] - c.m)), 6) AS inertia FROM pts p JOIN centres c ON p.label = c.label",
       (), {"pts": POINTS, "centres": CENTRES})
def _(spark, sf):
    return r6(m.inertia(vec(spark, sf)))


@query("generalization_ratio", """
SELECT model, param, round(silhouette / dbi * 1e2, 6) AS generalization_pct FROM cluster_trials""", ("cluster_trials",))
def _(spark, sf):
    from zonalis.plans.adapters import cluster_trials
    return r6(m.generalization_ratio(cluster_trials(spark, sf), "dbi", "silhouette").select("model", "param", "generalization_pct"))


@query("overfit_flag", """
SELECT model, param, coalesce(silhouette < 5e-1 * dbi, false) AS overfit FROM cluster_trials""", ("cluster_trials",))
def _(spark, sf):
    from zonalis.plans.adapters import cluster_trials
    df = cluster_trials(spark, sf).select("model", "param", F.col("dbi").alias("train_silhouette"), F.col("silhouette").alias("test_silhouette"))
    return m.overfit_flag(df).select("model", "param", "overfit")


# --- clustering of zones --------------------------------------------------------------------------------------------------

ZONE_FEATURES = [*a.ROLLUP_MEANS, *a.ROLLUP_FIRST]


def zone_tables(spark, sf):
    """Scaled zone points of the train and the test days (id, square_id, features)."""
    train, test = joins.attach_zone_stats(*split_by_day(valid(spark, sf)))
    rolled = [a.zone_rollup(c.throughput_features(c.row_stats(df))).fillna(0.0, ZONE_FEATURES) for df in (train, test)]
    scaled = e.standard_scale(materialize(rolled[0]), materialize(rolled[1]), ZONE_FEATURES)
    return tuple(materialize(cl.zone_points(df, ZONE_FEATURES)) for df in scaled)


FEATURED = ROW_FEATURES.replace("FROM telemetry", "FROM split")
ZONE_SCALED = ", ".join(f"(v.{n} - avg(v.{n}) OVER ()) / coalesce(nullif(stddev_pop(v.{n}) OVER (), 0), 1)" for n in ZONE_FEATURES)
ZONE_VIEWS = {
    "valid": VALID, "split": SPLIT.replace("telemetry", "valid"), "zone_raw": ZONE_RAW, "zones": ZONES, "featured": FEATURED,
    "rolled": f"""SELECT f.square_id, {', '.join(f'coalesce(avg({n}), 0) AS {n}' for n in a.ROLLUP_MEANS)}, {', '.join(f'coalesce(min(z.{n}), 0) AS {n}' for n in a.ROLLUP_FIRST)}
FROM featured f JOIN zones z ON f.square_id = z.square_id WHERE NOT f.is_test GROUP BY f.square_id""",
    "zone_pts": f"SELECT row_number() OVER (ORDER BY square_id) - 1 AS id, square_id, [{ZONE_SCALED}] AS f FROM rolled v",
    "pairs": "SELECT x.id, y.id AS other, sqrt(list_sum(list_transform(list_zip(x.f, y.f), lambda p : (p[1] - p[2]) * (p[1] - p[2])))) AS d FROM zone_pts x, zone_pts y",
}


def density_sql(eps: str, least: int) -> str:
    """Clusters of core points within ``eps`` of each other, border points by the lowest, -1 for the rest."""
    return f"""
SELECT p.square_id, coalesce(c.label, -1) AS label FROM zone_pts p LEFT JOIN (
  SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS label FROM (
    SELECT n.id, min(CASE WHEN k.id IS NOT NULL THEN r.root END) AS root FROM near n LEFT JOIN core k ON n.other = k.id LEFT JOIN roots r ON n.other = r.id
    WHERE n.id NOT IN (SELECT id FROM core) OR n.id = n.other GROUP BY n.id) m WHERE root IS NOT NULL) c ON p.id = c.id""", {
        "near": f"SELECT id, other FROM pairs WHERE d <= {eps}",
        "core": f"SELECT id FROM near GROUP BY id HAVING count(*) >= {least}",
        "reached": "SELECT id, id AS root FROM core UNION SELECT n.other, r.root FROM reached r JOIN near n ON n.id = r.id JOIN core k ON n.other = k.id",
        "roots": "SELECT id, min(root) AS root FROM reached GROUP BY id",
    }


def tree_views(samples: int, doublings: int = 8) -> dict[str, str]:
    """Edges ranked by mutual reachability (then by ids), and ``linked``: per pair the least possible worst rank of a path."""
    views = ZONE_VIEWS | {
        "cores": f"SELECT id, max(d) AS core FROM (SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS n FROM pairs) WHERE n <= {samples} GROUP BY id",
        "edges": """SELECT p.id AS low, p.other AS high, greatest(round(d, 9), round(a.core, 9), round(b.core, 9)) AS w FROM pairs p
  JOIN cores a ON a.id = p.id JOIN cores b ON b.id = p.other WHERE p.id < p.other""",
        "ranked": "SELECT low, high, w, row_number() OVER (ORDER BY w, low, high) AS r FROM edges",
        "m0": "SELECT low AS i, high AS j, r FROM ranked UNION ALL SELECT high, low, r FROM ranked UNION ALL SELECT id, id, 0 FROM zone_pts",
    }
    for step in range(doublings):
        views[f"m{step + 1}"] = f"SELECT a.i, b.j, min(greatest(a.r, b.r)) AS r FROM m{step} a JOIN m{step} b ON a.j = b.i GROUP BY a.i, b.j"
    views["linked"] = f"SELECT m.i, m.j, coalesce(k.w, 0) AS w, m.r FROM m{doublings} m LEFT JOIN ranked k ON k.r = m.r"
    return views


def hierarchy_views(least: int, samples: int, rounds: int = 12) -> dict[str, str]:
    """Condensed tree over every distinct weight, and excess of mass by repeated sums over children."""
    views = tree_views(samples) | {
        "levels": "SELECT w AS e, row_number() OVER (ORDER BY w DESC) - 1 AS level FROM (SELECT DISTINCT w FROM linked WHERE w > 0)",
        "member": f"""SELECT * FROM (SELECT level, e, id, comp, count(*) OVER (PARTITION BY level, comp) AS size FROM (
  SELECT l.level, l.e, k.i AS id, min(k.j) AS comp FROM levels l JOIN linked k ON k.w <= l.e GROUP BY ALL)) WHERE size >= {least}""",
        "nodes": "SELECT level, comp, any_value(e) AS e FROM member GROUP BY level, comp",
        "ups": "SELECT n.level, n.comp, m.comp AS up, count(*) OVER (PARTITION BY n.level, m.comp) AS siblings FROM nodes n LEFT JOIN member m ON m.level = n.level - 1 AND m.id = n.comp",
        "chain": """SELECT level, comp, level * 1000000 + comp AS cl FROM ups WHERE up IS NULL OR siblings > 1
  UNION ALL SELECT u.level, u.comp, c.cl FROM chain c JOIN ups u ON u.level = c.level + 1 AND u.up = c.comp AND u.siblings = 1""",
        "births": """SELECT c.cl, c.level, c.comp, p.cl AS parent, CASE WHEN c.level = 0 THEN 0 ELSE 1 / l.e END AS born FROM chain c
  JOIN ups u ON u.level = c.level AND u.comp = c.comp LEFT JOIN chain p ON p.level = c.level - 1 AND p.comp = u.up LEFT JOIN levels l ON l.level = c.level - 1
  WHERE c.cl = c.level * 1000000 + c.comp""",
        "leaving": "SELECT c.cl, m.id, min(m.e) AS e FROM member m JOIN chain c ON c.level = m.level AND c.comp = m.comp GROUP BY c.cl, m.id",
        "r0": "SELECT b.cl, b.parent, sum(1 / l.e - b.born) AS stability, CAST(0 AS DOUBLE) AS below FROM births b JOIN leaving l ON l.cl = b.cl GROUP BY b.cl, b.parent",
    }
    for step in range(rounds):
        views[f"r{step + 1}"] = f"""SELECT x.cl, x.parent, x.stability, coalesce(c.below, 0) AS below FROM r{step} x LEFT JOIN (
  SELECT parent, sum(CASE WHEN stability >= below THEN stability ELSE below END) AS below FROM r{step} GROUP BY parent) c ON c.parent = x.cl"""
    return views | {
        "wins": f"SELECT cl, parent, parent IS NOT NULL AND stability >= below AS wins FROM r{rounds}",
        "over": "SELECT cl, parent AS above FROM wins UNION ALL SELECT o.cl, w.parent FROM over o JOIN wins w ON w.cl = o.above",
        "kept": "SELECT cl FROM wins WHERE wins AND cl NOT IN (SELECT o.cl FROM over o JOIN wins w ON w.cl = o.above WHERE w.wins)",
        "found": """SELECT m.id, k.cl, min(m.id) OVER (PARTITION BY k.cl) AS lowest FROM kept k JOIN births b ON b.cl = k.cl
  JOIN member m ON m.level = b.level AND m.comp = b.comp""",
    }


@query("kmeans_fit_assign")
def _(spark, sf):
    train, test = zone_tables(spark, sf)
    labelled, tested, cost = cl.kmeans_fit_assign(train, test, 2)
    both = labelled.withColumn("is_test", F.lit(False)).unionByName(tested.withColumn("is_test", F.lit(True)))
    return both.select("square_id", "is_test", "label", F.lit(cost).alias("inertia"))


@query("kmeans_nearest_mean", """
SELECT square_id, CAST(k AS BIGINT) AS k, true AS nearest, true AS cost_is_sum FROM zone_pts, range(2, 6) r(k)""", ("telemetry",), ZONE_VIEWS)
def _(spark, sf):
    """Whether every zone has the label of the nearest mean of the labelled rows, and the cost is their sum of squares."""
    train, _ = zone_tables(spark, sf)
    ks = [2, 3, 4, 5]
    fits = cl.kmeans_fits(train, ks)
    out = None
    for k, fit in zip(ks, fits, strict=True):
        labelled = materialize(cl.kmeans_assign(fit, train))
        means = F.broadcast(m.centroids(labelled).select(F.col("label").alias("other"), "centre"))  # k rows
        near = labelled.join(means).groupBy("id", "square_id", "label").agg(F.min(F.struct(m.squared_distance(F.col("features"), F.col("centre")).alias("d"), "other")).alias("best"))
        whole = near.agg(F.sum("best.d").alias("total"))
        row = near.crossJoin(F.broadcast(whole)).select("square_id", F.lit(k).cast("long").alias("k"), (F.col("best.other") == F.col("label")).alias("nearest"), (F.abs(F.col("total") - fit.cost) < 1e-6 * fit.cost).alias("cost_is_sum"))
        out = row if out is None else out.unionByName(row)
    return out


@query("kmeans_sweep")
def _(spark, sf):
    return cl.kmeans_sweep(zone_tables(spark, sf)[0], list(range(2, 10)))


@query("dbscan", density_sql("15e-1", 3)[0], ("telemetry",), ZONE_VIEWS | density_sql("15e-1", 3)[1], recursive=True)
def _(spark, sf):
    train, _ = zone_tables(spark, sf)
    return train.join(cl.dbscan(train, 1.5, 3), "id").select("square_id", F.col("label").cast("long").alias("label"))


@query("dbscan_vectors", """
SELECT p.id, coalesce(c.label, -1) AS label FROM pts p LEFT JOIN (
  SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS label FROM (
    SELECT n.id, min(CASE WHEN k.id IS NOT NULL THEN r.root END) AS root FROM near n LEFT JOIN core k ON n.other = k.id LEFT JOIN roots r ON n.other = r.id
    WHERE n.id NOT IN (SELECT id FROM core) OR n.id = n.other GROUP BY n.id) m WHERE root IS NOT NULL) c ON p.id = c.id""", (), VEC | {
    "near": "SELECT id, other FROM pairs WHERE d <= 118e-2",
    "core": "SELECT id FROM near GROUP BY id HAVING count(*) >= 4",
    "reached": "SELECT id, id AS root FROM core UNION SELECT n.other, r.root FROM reached r JOIN near n ON n.id = r.id JOIN core k ON n.other = k.id",
    "roots": "SELECT id, min(root) AS root FROM reached GROUP BY id"}, recursive=True)
def _(spark, sf):
    return cl.dbscan(vec(spark, sf), 1.18, 4).withColumn("label", F.col("label").cast("long"))


@query("dbscan_cut", density_sql("2e0", 5)[0], ("telemetry",), ZONE_VIEWS | density_sql("2e0", 5)[1], recursive=True)
def _(spark, sf):
    train, _ = zone_tables(spark, sf)
    return train.join(cl.dbscan_cut(train, 5, 2.0), "id").select("square_id", F.col("label").cast("long").alias("label"))


@query("cf_microcluster")
def _(spark, sf):
    train, _ = zone_tables(spark, sf)
    return cl.cf_microcluster(train, 0.5, 2).select("square_id", "label")


@query("density_hierarchy", """
SELECT p.square_id, coalesce(l.label, -1) AS label FROM zone_pts p LEFT JOIN (SELECT id, dense_rank() OVER (ORDER BY lowest) - 1 AS label FROM found) l ON l.id = p.id""",
       ("telemetry",), hierarchy_views(5, 3), recursive=True)
def _(spark, sf):
    train, _ = zone_tables(spark, sf)
    return train.join(cl.density_hierarchy(train, 5, 3), "id").select("square_id", F.col("label").cast("long").alias("label"))


@query("mst_boruvka", "SELECT k.low, k.high, round(k.w, 6) AS weight FROM ranked k JOIN linked l ON l.i = k.low AND l.j = k.high AND l.r = k.r", ("telemetry",), tree_views(3))
def _(spark, sf):
    return r6(cl.mst_boruvka(zone_tables(spark, sf)[0], 3))


@query("param_sweep")
def _(spark, sf):
    return cl.param_sweep(zone_tables(spark, sf)[0])


@query("density_sweep")
def _(spark, sf):
    return cl.density_sweep(zone_tables(spark, sf)[0])


@query("microcluster_sweep")
def _(spark, sf):
    return cl.microcluster_sweep(zone_tables(spark, sf)[0])


@query("compare_clusterings")
def _(spark, sf):
    return comparison.compare_clusterings(*zone_tables(spark, sf))


@query("tune_clusterings")
def _(spark, sf):
    return comparison.tune_clusterings(zone_tables(spark, sf)[0])


@query("score_trials")
def _(spark, sf):
    train, test = zone_tables(spark, sf)
    return m.score_trials(train, test, comparison.chosen_clusterings(train, test))

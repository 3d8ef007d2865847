"""Model comparisons: clusterings of zones, forecasts of targets."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators import clustering as cl
from zonalis.operators.aggregates import ROLLUP_FIRST, ROLLUP_MEANS, zone_rollup
from zonalis.operators.cluster_metrics import generalization_ratio, score_trials
from zonalis.operators.encoding import standard_scale
from zonalis.operators.forecast_metrics import regression_metrics
from zonalis.operators.forecasting import arma_forecast, gbt_forecast
from zonalis.operators.neighbours import assign_to_clusters
from zonalis.operators.rankings import rank_models
from zonalis.operators.windows import interpolate_series
from zonalis.plans.materialize import materialize
from zonalis.plans.slices import Slices

FEATURES = [*ROLLUP_MEANS, *ROLLUP_FIRST]


def zone_points(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Zone rollups of both splits, missing as 0, scaled on train: (id, square_id, features)."""
    rolled = [materialize(zone_rollup(df).fillna(0.0, FEATURES)) for df in (train, test)]
    return tuple(materialize(cl.zone_points(df, FEATURES)) for df in standard_scale(*rolled, FEATURES))


def chosen_clusterings(train: DataFrame, test: DataFrame, n_init: int = 10) -> dict[tuple[str, str], tuple[DataFrame, DataFrame]]:
    """Labels (id, label) of both splits by five clusterings with their chosen settings."""
    trials = {}
    labelled, tested, _ = cl.kmeans_fit_assign(train, test, 2, n_init)
    trials["KMeans", "k=2"] = (labelled.select("id", "label"), tested.select("id", "label"))
    settings = {
        ("DBSCAN", "eps=0.5,min=3"): lambda: cl.dbscan(train, 0.5, 3),
        ("Birch", "k=2,threshold=0.2"): lambda: cl.cf_microcluster(train, 0.2, 2, n_init).select("id", "label"),
        ("OPTICS", "min=5,cut=1.5"): lambda: cl.dbscan_cut(train, 5, 1.5),
        ("HDBSCAN", "size=5,min=3"): lambda: cl.density_hierarchy(train, 5, 3),
    }
    for name, run in settings.items():
        dense = materialize(train.join(run(), "id"))
        trials[name] = (dense.select("id", "label"), assign_to_clusters(dense, test))
    return trials


def compare_clusterings(train: DataFrame, test: DataFrame, n_init: int = 10) -> DataFrame:
    """Five clusterings with their chosen settings, scored on both splits and ranked by the test figures."""
    scored = materialize(score_trials(train, test, chosen_clusterings(train, test, n_init)))
    ranked = rank_models(scored.withColumnsRenamed({
        "silhouette": "train_silhouette", "dbi": "train_dbi", "calinski_harabasz": "train_calinski_harabasz",
        "test_silhouette": "silhouette", "test_dbi": "dbi", "test_calinski_harabasz": "calinski_harabasz",
    }))
    return generalization_ratio(ranked, "train_silhouette", "silhouette")


def tune_clusterings(
    points: DataFrame, ks: list[int] = list(range(2, 10)), dbscan: list[tuple[float, int]] = cl.DBSCAN_GRID,
    micro: list[tuple[float, int]] = cl.MICROCLUSTER_GRID, cut: list[tuple[float, int]] = cl.DBSCAN_CUT_GRID,
    density: list[tuple[int, int | None]] = cl.HDBSCAN_GRID, **limits: int,
) -> DataFrame:
    """All settings of all clusterings as ranked trial rows; settings with fewer than two clusters are left out."""
    points = materialize(points)
    kmeans = cl.kmeans_sweep(points, ks, **limits).select(
        F.lit("KMeans").alias("model"), F.concat(F.lit("k="), "k").alias("param"), "silhouette", "dbi", "calinski_harabasz"
    )
    parts = [
        kmeans,
        cl.radius_sweeps(points, {"DBSCAN": dbscan, "OPTICS": cut}, **limits),
        cl.microcluster_sweep(points, micro, **limits),
        cl.density_sweep(points, density, **limits),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return rank_models(materialize(out.filter(F.col("silhouette").isNotNull())))


def compare_forecasts(
    train: DataFrame, test: DataFrame, targets: list[str], numeric: list[str], categorical: list[str], order: list[str],
    horizon: int | None = None, **trees
) -> DataFrame:
    """Metric rows (target, model, mae, mse, rmse, r2) of boosted trees and of the series model per target.

    The series model forecasts as many steps as the test has rows, or ``horizon`` when given, and is scored on the test
    series with its gaps interpolated. Targets are fitted at the same time: their many small jobs share the cluster.
    """
    steps = test.count() if horizon is None else horizon

    def of_target(target: str) -> DataFrame:
        predicted, _, _ = gbt_forecast(train, test, target, [n for n in numeric if n != target], categorical, **trees)
        rows = [("XGBoost", regression_metrics(predicted, [], target, "prediction"))]
        ahead = arma_forecast(train, [], order, target, steps=steps)
        series = interpolate_series(test.select(*order, target), [], order, target)
        actual = Slices(series, [], order).numbered("step").filter(F.col("step") <= steps)
        rows.append(("ARIMA", regression_metrics(actual.join(ahead, "step"), [], target, "forecast").withColumn("r2", F.lit(None).cast("double"))))
        out = None
        for model, metrics in rows:
            row = metrics.select(F.lit(target).alias("target"), F.lit(model).alias("model"), "*")
            out = row if out is None else out.unionByName(row)
        return materialize(out)

    with ThreadPoolExecutor(len(targets)) as pool:
        parts = list(pool.map(inheritable_thread_target(train.sparkSession)(of_target), targets))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

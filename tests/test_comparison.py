"""Whole comparison flows on zone tables."""

from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions.predicates import drop_invalid_gps
from zonalis.operators.joins import attach_zone_stats
from zonalis.operators.ordering import split_by_day
from zonalis.plans import comparison
from zonalis.plans.adapters import telemetry


def test_clusterings_are_compared_and_tuned(spark, small):
    train, test = attach_zone_stats(*split_by_day(drop_invalid_gps(telemetry(spark, small))))
    points = comparison.zone_points(*(c.throughput_features(c.row_stats(df)) for df in (train, test)))
    ranked = comparison.compare_clusterings(*points, n_init=1).collect()
    assert [r.model for r in ranked].count("KMeans") == 1 and len(ranked) == 5
    assert sorted(r.rank for r in ranked) == [1, 2, 3, 4, 5]
    for r in ranked:
        assert r.train_silhouette is None or -1 <= r.train_silhouette <= 1
        assert r.train_silhouette is None or r.silhouette is None or abs(r.generalization_pct - r.silhouette / r.train_silhouette * 100) < 1e-9
    tuned = comparison.tune_clusterings(points[0], [2], [(2.5, 3)], [(0.5, 2)], [(3.0, 3)], [(3, 2)])
    assert tuned.filter("model = 'KMeans'").count() == 1
    assert tuned.filter(F.col("combined_score").isNull()).count() == 0


def test_forecasts_are_compared(spark, small):
    df = telemetry(spark, small).na.drop(subset=["svr1"])
    train, test = split_by_day(df)
    out = comparison.compare_forecasts(train, test, ["svr1"], ["svr2", "svr3", "hour"], ["square_id"], ["ts", "event_id"], trees=3).collect()
    assert {(r.target, r.model) for r in out} == {("svr1", "XGBoost"), ("svr1", "ARIMA")}
    assert all(r.mae > 0 and r.rmse >= r.mae for r in out)

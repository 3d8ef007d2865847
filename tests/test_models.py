"""Forecasting, scoring and ranking."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.operators import encoding as e
from zonalis.operators import forecast_metrics as fm
from zonalis.operators import forecasting as fc
from zonalis.operators import ordering as o
from zonalis.operators import rankings as k
from zonalis.operators.windows import difference_weights
from zonalis.plans import preparation


def series(spark, values, key="a", start=0):
    return [(key, start + i, float(v)) for i, v in enumerate(values)]


SCHEMA = "key string, at long, y double"


def test_autoregression_recovers_coefficients(spark):
    rng = np.random.default_rng(1)
    rows = []
    for name, (a, b, c) in {"p": (0.5, 0.3, 2.0), "q": (-0.4, 0.2, -1.0)}.items():
        y = [0.0, 0.0]
        for _ in range(3000):
            y.append(c + a * y[-1] + b * y[-2] + rng.normal(0, 0.1))
        rows += series(spark, y, name)
    df = spark.createDataFrame(rows, SCHEMA)
    for width in (None, 400):
        fit = fc.fit_series(df, ["key"], ["at"], "y", pdq=(2, 0, 0), width=width)
        beta = {r.key: r.beta for r in fit.coefficients.collect()}
        assert beta["p"] == pytest.approx([2.0, 0.5, 0.3], abs=0.15)
        assert beta["q"] == pytest.approx([-1.0, -0.4, 0.2], abs=0.15)


def test_moving_average_part(spark):
    rng = np.random.default_rng(2)
    e_ = rng.normal(0, 1, 6000)
    y = e_[1:] + 0.6 * e_[:-1]
    fit = fc.fit_series(spark.createDataFrame(series(spark, y), SCHEMA), ["key"], ["at"], "y", pdq=(0, 0, 1))
    assert fit.coefficients.first().beta[1] == pytest.approx(0.6, abs=0.08)


def test_trend_is_continued(spark):
    df = spark.createDataFrame(series(spark, [3.0 * i + (i % 2) * 1e-3 for i in range(60)]), SCHEMA)
    ahead = fc.arma_forecast(df, ["key"], ["at"], "y", pdq=(1, 1, 0), steps=5).orderBy("step").collect()
    assert [r.forecast for r in ahead] == pytest.approx([3.0 * (60 + i) for i in range(5)], abs=0.05)


def test_season_is_continued(spark):
    rng = np.random.default_rng(3)
    shape = 10 * np.sin(np.arange(24) / 24 * 2 * np.pi)
    values = [shape[i % 24] + 0.01 * i + rng.normal(0, 0.05) for i in range(24 * 20)]
    rows = [(i, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i long, y double").withColumn("hour_start", F.expr("TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, CAST(i AS INT))"))
    out = fc.seasonal_arma_forecast(df, [], "hour_start", "y").orderBy("step").collect()
    assert len(out) == 24 and str(out[0].hour_start) == "2024-01-21 00:00:00"
    assert [r.forecast for r in out] == pytest.approx([shape[i % 24] + 0.01 * (480 + i) for i in range(24)], abs=0.6)


def test_short_series_have_null_forecasts(spark):
    df = spark.createDataFrame(series(spark, range(6)) + series(spark, [1, 2, 4, 3, 5, 6, 8, 7, 9, 11, 10, 12, 14, 13], "b"), SCHEMA)
    got = fc.arma_forecast(df, ["key"], ["at"], "y", (1, 0, 0), 3).collect()
    assert sorted((r.key, r.step) for r in got) == [(k, s) for k in "ab" for s in (1, 2, 3)]
    assert all((r.forecast is None) == (r.key == "a") for r in got)


def test_difference_weights():
    assert difference_weights(1) == {0: 1.0, 1: -1.0}
    assert difference_weights(2) == {0: 1.0, 1: -2.0, 2: 1.0}
    assert difference_weights(1, 1, 24) == {0: 1.0, 1: -1.0, 24: -1.0, 25: 1.0}


def test_window_regressor_and_pick(spark):
    rng = np.random.default_rng(5)
    y = np.sin(np.arange(600) / 5) * 4 + 10
    df = spark.createDataFrame([(i, float(v), float(rng.normal())) for i, v in enumerate(y)], "at long, y double, noise double")
    train, test = df.filter("at < 480"), df.filter("at >= 480")
    for estimator in ("linear", "trees"):
        out = fc.window_regressor(train, test, [], ["at"], ["y", "noise"], ["y"], 4, estimator, trees=10, ridge=0.0).collect()
        assert {r.split for r in out} == {"validation", "test"} and all(r.r2 > 0.9 for r in out)
    best = fc.hyperparam_pick(train, test, [{"lookback": 1}, {"lookback": 6}], keys=[], order=["at"], features=["y"], targets=["y"]).first()
    assert best.param == "lookback=6"


def test_window_predictions_equal_plain_least_squares(spark):
    rng = np.random.default_rng(8)
    y = np.cumsum(rng.normal(size=260))
    z = 2 * np.roll(y, 1) + rng.normal(size=260)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, z))], "at long, y double, z double")
    out = fc.window_predictions(df.filter("at < 200"), df.filter("at >= 200"), [], ["at"], ["y", "z"], ["y", "z"], 3, ridge=0.0)
    assert out.columns == ["target", "split", "at", "actual", "predicted", "residual"]
    got = {(r.target, r.at): r for r in out.collect()}
    assert len(got) == 2 * (29 + 57)  # 15 % of the 197 training windows, and the test windows
    both = np.stack([y, z], 1)
    for name, values in (("y", y), ("z", z)):
        x = np.array([np.append(both[i - 3 : i].ravel(), 1.0) for i in range(3, 171)])
        beta = np.linalg.lstsq(x, values[3:171], rcond=None)[0]
        for i in [*range(171, 200), *range(203, 260)]:
            r = got[name, i]
            expected = float(np.append(both[i - 3 : i].ravel(), 1.0) @ beta)
            assert (r.split, r.actual) == ("validation" if i < 200 else "test", pytest.approx(values[i]))
            assert r.predicted == pytest.approx(expected, abs=1e-5) and r.residual == pytest.approx(values[i] - expected, abs=1e-5)
    empty = fc.window_regressor(df.filter("at < 200"), df.filter("at >= 258"), [], ["at"], ["y"], ["y"], 3).collect()
    assert sorted((r.split, r.mae is None) for r in empty) == [("test", True), ("validation", False)]


def test_series_information_is_that_of_the_fit(spark):
    values = [3.0]
    rng = np.random.default_rng(9)
    for e in rng.normal(size=300):
        values.append(1 + 0.6 * values[-1] + float(e))
    df = spark.createDataFrame(series(spark, values) + series(spark, range(60), "b"), SCHEMA)
    got = {r.key: r for r in fc.series_information(df, ["key"], ["at"], "y", (1, 0, 0)).collect()}
    x = np.stack([np.ones(300), values[:-1]], 1)
    e = np.array(values[1:]) - x @ np.linalg.lstsq(x, np.array(values[1:]), rcond=None)[0]
    r = got["a"]
    assert (r.n, r.rmse, r.mae) == (300, pytest.approx(np.sqrt((e * e).mean())), pytest.approx(np.abs(e).mean()))
    assert r.aic == pytest.approx(300 * np.log((e * e).mean()) + 2 * 3) and r.bic == pytest.approx(300 * np.log((e * e).mean()) + 3 * np.log(300))
    assert got["b"].rmse == pytest.approx(0, abs=1e-6)


def test_imputation_flow(spark):
    """Medians by day key, then neighbours for latencies that are not in the columns of the medians."""
    rows = [(i, "z", f"2024-01-{1 + i // 8:02d}", float(i % 5), None if i % 4 == 1 else float(2 * (i % 5)), None if i % 3 == 0 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "n long, square_id string, day_id string, svr1 double, svr2 double, upload_mbps double")
    train, test, both, columns = preparation.impute_flow(df, columns=["upload_mbps"])
    assert columns == ["upload_mbps"] and set(both.columns) == {*df.columns, "date_key"}
    assert (train.count(), test.count(), both.count()) == (32, 8, 40)
    got = {r.n: r for r in both.collect()}
    for n, _, day, one, two, up in rows:
        donors = sorted((abs(one - a), j, b) for j, _, _, a, b, _ in rows[:32] if b is not None)[:5]
        assert got[n].svr2 == pytest.approx(two if two is not None else np.mean([b for *_, b in donors]))
        day_values = [v for j, _, d, _, _, v in rows[:32] if d == day and v is not None] or [v for *_, v in rows[:32] if v is not None]
        assert got[n].upload_mbps == pytest.approx(up if up is not None else np.median(day_values))
    plain, _, _, chosen = preparation.impute_flow(df, "n", neighbours=None)
    assert chosen == ["svr2", "upload_mbps"] and plain.filter("svr2 IS NULL").isEmpty()


def test_trees_beat_the_mean(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(x), "ab"[i % 2], float(3 * x + (i % 2) * 5)) for i, x in enumerate(rng.uniform(0, 10, 400))]
    df = spark.createDataFrame(rows, "i long, x double, c string, y double")
    out, model, features = fc.gbt_forecast(df.filter("i < 300"), df.filter("i >= 300"), "y", ["x"], ["c"], trees=15)
    assert fm.regression_metrics(out, [], "y", "prediction").first().r2 > 0.9
    assert [r.feature for r in fc.feature_importance(df, model, features).collect()] == ["x", "c_code"]
    with pytest.raises(ValueError):
        fc.gbt_forecast(df.filter("i < 0"), df, "y", ["x"], trees=2)


def test_boosting_uses_all_cores(spark, monkeypatch):
    df = spark.range(900).selectExpr("cast(id as double) AS x", "id % 7 + 0.5 AS y").coalesce(1)
    taken, fit = [], fc.GBTRegressor.fit
    monkeypatch.setattr(fc, "TREE_ROWS", 300)
    monkeypatch.setattr(fc, "LEAST_TREE_ROWS", 100)
    monkeypatch.setattr(fc.GBTRegressor, "fit", lambda self, rows: taken.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    for n in (500, 900):
        out, _, _ = fc.gbt_forecast(df.filter(f"x < {n}"), df, "y", ["x"], trees=2)
        assert out.count() == 900
    assert taken == [1, min(spark.sparkContext.defaultParallelism, 9)]


def test_regression_metrics_of_constant_target(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 1.0), ("b", 1.0, 1.0), ("b", 3.0, 2.0), ("b", None, 2.0)], "k string, y double, p double")
    rows = {r.k: r for r in fm.regression_metrics(df, ["k"], "y", "p").collect()}
    assert rows["a"].r2 is None and rows["a"].mae == 0.5 and rows["b"].r2 == 0.5
    assert fm.mape(df, ["k"], "y", "p").filter("k = 'a'").first().mape == 50.0


def test_best_models_and_order(spark):
    df = spark.createDataFrame([("t", "b", 1.0, 2.0, 4.0, None), ("t", "a", 1.0, 3.0, 9.0, 0.2), ("u", "c", None, 1.0, 1.0, 0.1)],
                               "target string, model string, mae double, rmse double, mse double, r2 double")
    best = [tuple(r) for r in fm.best_model_table(df).collect()]
    assert best == [("t", "best_mae", "a", 1.0), ("t", "best_mse", "b", 4.0), ("t", "best_r2", "a", 0.2), ("t", "best_rmse", "b", 2.0),
                    ("u", "best_mse", "c", 1.0), ("u", "best_r2", "c", 0.1), ("u", "best_rmse", "c", 1.0)]
    assert [r.model for r in fm.order_models(df, ["c", "x"]).collect()] == ["c", "a", "b"]


def test_ranking(spark):
    df = spark.createDataFrame([("a", "1", 0.5, 1.0, 7.0), ("b", "1", 0.1, 3.0, 7.0), ("c", "1", None, 2.0, 7.0)],
                               "model string, param string, silhouette double, dbi double, calinski_harabasz double")
    out = k.rank_models(df).orderBy("rank").collect()
    assert [(r.model, r.combined_score) for r in out] == [("a", pytest.approx(0.7)), ("b", pytest.approx(0.0)), ("c", None)]
    assert out[0].calinski_harabasz_norm == 0.0
    best = k.best_per_group(df.withColumn("model", F.lit("m")), ["model"], "dbi", False, ["param"]).first()
    assert best.dbi == 1.0


def test_codes_scalers_and_selection(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), (None, float("inf"))], "c string, x double")
    test = spark.createDataFrame([("c", 5.0), ("a", None)], "c string, x double")
    a, b = e.encode_categories(train, test, ["c"])
    assert [r.c_code for r in a.collect()] == [1, 0, -1] and [r.c_code for r in b.collect()] == [2, 0]
    a, _ = e.encode_categories(train, test, ["c"], null_text="nan")
    assert [r.c_code for r in a.collect()] == [1, 0, 3]
    a, b = e.impute_feature_median(train, test, ["x"])
    assert [r.x for r in a.collect()] == [1.0, 3.0, 2.0] and [r.x for r in b.collect()] == [5.0, 2.0]
    scaler = e.Scaler.minmax(spark.createDataFrame([(2.0, 7.0), (4.0, 7.0)], "x double, flat double"), ["x", "flat"])
    row = scaler.apply(spark.createDataFrame([(3.0, 8.0)], "x double, flat double")).first()
    assert tuple(row) == (0.5, 1.0)
    assert spark.range(1).select(scaler.invert(F.lit(0.5), "x")).first()[0] == 3.0
    scaler = e.Scaler.standard(spark.createDataFrame([(1.0,), (3.0,)], "x double"), ["x"])
    assert scaler.divisor["x"] == 1.0


def test_pca_matches_svd(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (60, 3)) @ np.array([[3, 1, 0], [0, 1, 0.5], [0, 0, 0.2]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, a double, b double, c double")
    got = np.array([[r.pc1, r.pc2] for r in e.pca_2d(df, ["a", "b", "c"]).orderBy("i").collect()])
    centred = x - x.mean(axis=0)
    want = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-8)


def test_samples_and_heads(spark):
    df = spark.range(5000).withColumnRenamed("id", "at").repartition(5)
    one = sorted(r.at for r in o.sample_n(df, 40, "at").collect())
    assert len(one) == 40 and one == sorted(r.at for r in o.sample_n(df.repartition(3), 40, "at").collect())
    assert o.sample_n(df, 9000, "at").count() == 5000
    old, o.DRIVER_LIMIT = o.DRIVER_LIMIT, 10
    try:
        assert sorted(r.at for r in o.head_sequential(df, 100, ["at"], width=64).collect()) == list(range(100))
    finally:
        o.DRIVER_LIMIT = old
    share = o.sample_fraction_by_hash(df, 0.25, "at").count() / 5000
    assert 0.2 < share < 0.3


def test_registered_queries_do_full_work(monkeypatch):
    """Arguments that the queries hand to operators; the operators are stood in for."""
    from zonalis.queries import ALL, models, space

    calls = {}
    def stand_in(name, result):
        return lambda *args, **given: calls.setdefault(name, []).append((args, given)) or result
    monkeypatch.setattr(models, "splits", lambda *_: ("train", "test"))
    monkeypatch.setattr(space, "zone_tables", lambda *_: ("train", "test"))
    monkeypatch.setattr(models.fc, "gbt_forecast", stand_in("gbt", (type("Rows", (), {"select": lambda *_: None})(), None, None)))
    monkeypatch.setattr(models.fc, "feature_importance", lambda *_: None)
    monkeypatch.setattr(space.cl, "param_sweep", stand_in("sweep", None))
    for name in ("gbt_forecast", "feature_importance", "param_sweep"):
        ALL[name](None, None)
    assert [(args[4], given) for args, given in calls["gbt"]] == [(["square_id"], {})] * 2
    assert calls["sweep"] == [(("train",), {})]
    assert {"density_sweep", "microcluster_sweep", "compare_clusterings", "tune_clusterings", "compare_forecasts"} <= set(ALL)


def test_forecast_steps_equal_plain_recursion_and_stay_bounded():
    from zonalis.plans import kernels

    rng = np.random.default_rng(8)
    n, ar, ma, weights, steps = 10_000, [1, 3], [2], difference_weights(1), 12
    frame = kernels.pd.DataFrame({
        "key": np.arange(n), "beta": list(np.column_stack([rng.normal(0, 1, n), rng.uniform(-0.4, 0.4, (n, 3))])),
        "w_tail": [rng.normal(0, 1, rng.integers(0, 5)).tolist() for _ in range(n)], "e_tail": [rng.normal(0, 1, 3).tolist() for _ in range(n)],
        "y_tail": [rng.normal(0, 1, 2 if i else 0).tolist() for i in range(n)],
    })
    got = next(kernels.roll_forward([frame], ["key"], ar, ma, weights, steps))
    assert len(got) == n * steps and got[got.key == 0].forecast.isna().all()
    for key in range(1, 60):
        row = frame.iloc[key]
        w, e, y, want = list(row.w_tail), list(row.e_tail), list(row.y_tail), []
        for _ in range(steps):
            value = row.beta[0] + sum(b * w[-k] for b, k in zip(row.beta[1:], ar) if k <= len(w)) + (row.beta[3] * e[-2] if len(e) > 1 else 0)
            w.append(value)
            e.append(0.0)
            y.append(y[-1] + value)
            want.append(y[-1])
        assert got[got.key == key].forecast.astype(float).tolist() == pytest.approx(want)
    wild = kernels.stationary(np.array([[0.0, 1.5, 0.0], [1.0, 0.5, 0.2]]), [1, 2])
    assert wild[0, 1] == pytest.approx(0.999) and wild[1].tolist() == [1.0, 0.5, 0.2]


def test_boosting_over_binned_rows(spark, monkeypatch):
    from zonalis.plans import boosting

    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 20, 4000).astype(float), rng.random(4000), rng.random(4000)], axis=1)
    y = np.where(x[:, 0] > 7, 3.0, 0.0) + np.sin(6 * x[:, 1]) + rng.normal(0, 0.05, 4000)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    train, test = df.limit(3000), df
    law = dict(trees=8, rate=0.08, depth=3, rows=1.0, columns=1.0)

    def outcome(rows=None):
        out, model, names = fc.gbt_forecast(train, test, "y", ["a", "b", "c"], **(law | (rows or {})))
        pred = out.select((F.col("prediction") - F.col("y")).alias("e"), "prediction").toPandas()
        return pred, {r.feature: r.importance for r in fc.feature_importance(df, model, names).collect()}, model

    spark_way = outcome()
    monkeypatch.setattr(fc, "BINNED_ROWS", 1000)
    one = outcome()
    assert isinstance(one[2], boosting.Boosted) and not isinstance(spark_way[2], boosting.Boosted)
    # cuts differ a little, the law does not
    assert np.abs(one[0].prediction - spark_way[0].prediction).mean() < 0.03
    assert abs(one[0].e.std() - spark_way[0].e.std()) < 0.01
    assert max(abs(one[1][n] - spark_way[1][n]) for n in "abc") < 0.02
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "CHAIN", 3)
    many = outcome()
    assert np.allclose(many[0].prediction, one[0].prediction) and np.allclose([many[1][n] for n in "abc"], [one[1][n] for n in "abc"])
    shared = outcome({"rows": 0.9, "columns": 0.5})
    assert len(shared[0]) == 4000 and shared[0].e.std() < 0.6


def test_binned_tree_against_brute_force():
    from zonalis.plans import boosting

    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 6, (300, 3)).astype(float), rng.random(300)
    cuts = [np.arange(5.0)] * 3
    tree, = boosting.fit_block(boosting.Block(0, boosting.binned(x, cuts), y), 1, 0.1, 2, 1.0, 1.0, 42)

    def grown(rows, depth):
        options = [(sum(((y[p] - y[p].mean()) ** 2).sum() for p in (rows[x[rows, j] <= c], rows[x[rows, j] > c])), j, c)
                   for j in range(3) for c in range(5) if 0 < (x[rows, j] <= c).sum() < len(rows)]
        if not depth or not options:
            return {int(r): y[rows].mean() for r in rows}
        _, j, c = min(options)
        return grown(rows[x[rows, j] <= c], depth - 1) | grown(rows[x[rows, j] > c], depth - 1)

    wanted = grown(np.arange(300), 2)
    assert np.allclose(tree.value[tree.place(boosting.binned(x, cuts))], [wanted[i] for i in range(300)])

"""Forecasting: boosted trees, windowed regressors and autoregressive series models."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import clean_non_finite
from zonalis.operators.encoding import Scaler, align_target, assembled, encode_categories, impute_feature_median
from zonalis.operators.forecast_metrics import regression_metrics
from zonalis.operators.ordering import split_tail
from zonalis.operators.windows import difference_weights, interpolate_series, sequence_windows
from zonalis.plans import boosting, kernels
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join
from zonalis.plans.slices import Slices, slice_width

SERIES = "__series"
TREE_ROWS = 100_000  # rows per partition that boosting works on
LEAST_TREE_ROWS = 25_000  # the same where cores would stand idle otherwise
BINNED_ROWS = 200_000  # from here on trees grow over binned rows, see plans/boosting.py


# --- boosted trees --------------------------------------------------------------------------------------------------------


def gbt_forecast(
    train: DataFrame, test: DataFrame, target: str, numeric: list[str], categorical: list[str] | None = None,
    trees: int = 300, rate: float = 0.08, depth: int = 6, rows: float = 0.9, columns: float = 0.9, seed: int = 42,
):
    """(test rows with ``prediction``, fitted model, feature names). Codes are shared by both splits, medians come from train."""
    categorical = categorical or []
    train, test = align_target(train, target), align_target(test, target)
    train, test = encode_categories(train, test, categorical)
    train, test = impute_feature_median(train, test, numeric)
    features = [*numeric, *[f"{c}_code" for c in categorical]]
    ready = materialize(assembled(train, features, "__f").select("__f", F.col(target).cast("double").alias("__y")))
    n = ready.count()
    if not n:
        raise ValueError(f"no rows left for target {target}")
    if n >= BINNED_ROWS:
        model = boosting.fit(ready, n, trees, rate, depth, rows, columns, seed)
        return model.transform(assembled(test, features, "__f")).drop("__f"), model, features
    # Every level of every tree is a job, so partitions that hold too few rows cost more than they save.
    # From two partitions on, rows are dealt anew: a stored table may have fewer files than there are cores.
    cores = ready.sparkSession.sparkContext.defaultParallelism
    parts = max(n // TREE_ROWS, min(cores, n // LEAST_TREE_ROWS))
    ready = ready.coalesce(1) if n < 2 * TREE_ROWS else ready.repartition(parts)
    model = GBTRegressor(
        featuresCol="__f", labelCol="__y", predictionCol="prediction", maxIter=trees, stepSize=rate, maxDepth=depth,
        subsamplingRate=rows, featureSubsetStrategy=str(columns), seed=seed,
    ).fit(ready)
    return model.transform(assembled(test, features, "__f")).drop("__f"), model, features


def feature_importance(df: DataFrame, model, features: list[str], top: int = 20) -> DataFrame:
    """(feature, importance), strongest first; the vector has one entry per feature."""
    rows = sorted(((f, float(v)) for f, v in zip(features, model.featureImportances.toArray())), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows[:top], "feature string, importance double")


def residuals(df: DataFrame, actual: str, predicted: str, into: str = "residual") -> DataFrame:
    return df.withColumn(into, F.col(actual) - F.col(predicted))


# --- series models --------------------------------------------------------------------------------------------------------


def least_squares(df: DataFrame, keys: list[str], target: str, regressors: list[str]) -> DataFrame:
    """(keys, beta, n, sse) per series with an intercept: one aggregation of products, then a small solve per series."""
    names = [*regressors, target]
    usable = df.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in names], F.lit(0)) == 0)
    x = [F.lit(1.0), *[F.col(c) for c in regressors]]
    y = F.col(target)
    sums = usable.groupBy(*keys).agg(
        F.array(*[F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]).alias("xtx"),
        F.array(*[F.sum(v * y) for v in x]).alias("xty"), F.sum(y * y).alias("yy"), F.count(F.lit(1)).alias("n"),
    )
    types = dict(sums.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], "beta array<double>", "n bigint", "sse double"])
    width = len(x)

    def solve(batches):
        return kernels.solve_moments(batches, keys, width)

    return sums.mapInPandas(solve, schema)


def _linear(beta: Column, regressors: list[str]) -> Column:
    value = F.element_at(beta, 1)
    for i, name in enumerate(regressors):
        value = value + F.element_at(beta, i + 2) * F.col(name)
    return value


def _lags(p: int, seasonal: int, period: int) -> list[int]:
    return sorted({i + period * j for i in range(p + 1) for j in range(seasonal + 1)} - {0})


class SeriesFit:
    """Fitted coefficients per series and the rows they were fitted on (with in-sample residuals)."""

    def __init__(self, keys, order, ar, ma, weights, rows, coefficients, target, width):
        self.keys, self.order, self.ar, self.ma, self.weights = keys, order, ar, ma, weights
        self.rows, self.coefficients, self.target, self.width = rows, coefficients, target, width


def fit_series(
    df: DataFrame, keys: list[str], order: list[str], y: str, pdq: tuple[int, int, int] = (2, 1, 2),
    seasonal: tuple[int, int, int] = (0, 0, 0), period: int = 24, width: int | None = None,
) -> SeriesFit:
    """Two least-squares stages: a long autoregression supplies the innovations, then values and innovations are regressed.

    All series are fitted in the same jobs; a series may be spread over many tasks.
    """
    (p, d, q), (sp, sd, sq) = pdq, seasonal
    if not keys:
        df, keys = df.withColumn(SERIES, F.lit("all")), [SERIES]
    width = width or slice_width(df, keys, order[0])
    ar, ma, weights = _lags(p, sp, period), _lags(q, sq, period), difference_weights(d, sd, period)
    long = sorted(set(range(1, p + q + 4)) | set(_lags(1, max(sp, sq), period) if sp or sq else []))
    base = interpolate_series(df.select(*keys, *order, y), keys, order, y, width)
    lagged = Slices(base, keys, order, width).lags({f"__y{k}": (F.col(y), k) for k in weights if k > 0}) if max(weights) else base
    diff = F.col(y) * weights[0]
    for k, c in weights.items():
        diff = diff + F.col(f"__y{k}") * c if k > 0 else diff
    rows = materialize(lagged.withColumn("w", diff).select(*keys, *order, y, "w"))
    offsets = sorted(set(ar) | set(long if ma else []))
    rows = Slices(rows, keys, order, width).lags({f"w{k}": (F.col("w"), k) for k in offsets})
    if ma:
        names = [f"w{k}" for k in long]
        rows = materialize(rows)
        first = least_squares(rows, keys, "w", names).select(*keys, F.col("beta").alias("__b"))
        rows = lookup_join(rows, first, keys).withColumn("e", F.coalesce(F.col("w") - _linear(F.col("__b"), names), F.lit(0.0))).drop("__b")
        rows = Slices(materialize(rows), keys, order, width).lags({f"e{k}": (F.col("e"), k) for k in ma})
    names = [*[f"w{k}" for k in ar], *[f"e{k}" for k in ma]]
    rows = materialize(rows)
    coefficients = materialize(least_squares(rows, keys, "w", names))
    fitted = lookup_join(rows, coefficients.select(*keys, F.col("beta").alias("__b")), keys)
    fitted = fitted.withColumn("residual", F.col("w") - _linear(F.col("__b"), names))
    fitted = fitted.select(*keys, *order, y, "w", "residual")
    return SeriesFit(keys, order, ar, ma, weights, materialize(fitted), coefficients, y, width)


def forecast_series(fit: SeriesFit, steps: int, minimum: int = 10) -> DataFrame:
    """(keys, step, forecast) for every series; only the last few rows of a series are gathered.

    A series with fewer than ``minimum`` rows, or one whose equations have no solution, has rows with a null forecast.
    """
    depth = max([*fit.ar, *fit.ma, *fit.weights, 1])
    row = F.struct("w", F.coalesce("residual", F.lit(0.0)).alias("e"), F.col(fit.target).alias("y"))
    newest = _last_rows(fit, row, depth)
    counts = fit.rows.groupBy(*fit.keys).agg(F.count(F.lit(1)).alias("__n"))
    ready = (
        fit.coefficients.join(counts, fit.keys).filter(F.col("__n") >= minimum).join(newest, fit.keys)
        .select(
            *fit.keys, "beta", F.transform(F.filter("t", lambda s: s["r"]["w"].isNotNull()), lambda s: s["r"]["w"]).alias("w_tail"),
            F.transform("t", lambda s: s["r"]["e"]).alias("e_tail"), F.transform("t", lambda s: s["r"]["y"]).alias("y_tail"),
        )
    )
    types = dict(ready.dtypes)
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in fit.keys], "step int", "forecast double"])
    keys, ar, ma, weights = fit.keys, fit.ar, fit.ma, fit.weights

    def roll(batches):
        return kernels.roll_forward(batches, keys, ar, ma, weights, steps)

    known = materialize(ready.mapInPandas(roll, schema))
    unknown = counts.select(*keys).join(known.select(*keys).distinct(), keys, "left_anti")
    step = F.explode(F.sequence(F.lit(1), F.lit(steps))) if steps > 0 else F.explode(F.array().cast("array<int>"))
    return known.unionByName(unknown.select(*keys, step.alias("step"), F.lit(None).cast("double").alias("forecast")))


def arma_forecast(
    df: DataFrame, keys: list[str], order: list[str], y: str, pdq: tuple[int, int, int] = (2, 1, 2), steps: int = 100, width: int | None = None
) -> DataFrame:
    return _public(forecast_series(fit_series(df, keys, order, y, pdq, width=width), steps))


def seasonal_arma_forecast(
    hourly: DataFrame, keys: list[str], ts: str, y: str, pdq: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int] = (1, 1, 1),
    period: int = 24, steps: int = 24, width: int | None = None,
) -> DataFrame:
    """Next ``steps`` hours after the last hour of each series, with their timestamps."""
    fit = fit_series(hourly, keys, [ts], y, pdq, seasonal, period, width)
    last = fit.rows.groupBy(*fit.keys).agg(F.max(ts).alias("__last"))
    out = forecast_series(fit, steps).join(last, fit.keys)
    return _public(out.withColumn(ts, F.col("__last") + F.make_dt_interval(hours=F.col("step"))).drop("__last"))


def _public(df: DataFrame) -> DataFrame:
    return df.drop(SERIES)


def fit_information(df: DataFrame, keys: list[str], actual: str, residual: str, parameters: int) -> DataFrame:
    """n, AIC, BIC, in-sample MAE and RMSE of rows that have a residual."""
    usable = df.filter(F.col(residual).isNotNull())
    sums = usable.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(residual)).alias("mae"), F.avg(F.col(residual) * F.col(residual)).alias("__ms")
    )
    fit = F.col("n") * F.log("__ms")
    return sums.select(
        *keys, "n", (fit + 2 * parameters).alias("aic"), (fit + parameters * F.log(F.col("n"))).alias("bic"), "mae", F.sqrt("__ms").alias("rmse")
    )


def series_information(
    df: DataFrame, keys: list[str], order: list[str], y: str, pdq: tuple[int, int, int] = (2, 1, 2),
    seasonal: tuple[int, int, int] = (0, 0, 0), period: int = 24, width: int | None = None,
) -> DataFrame:
    """``fit_information`` of a fitted series model, per series: its own one-step errors on the rows it was fitted on.

    Parameters are the constant, the coefficients and the variance of the innovations.
    """
    fit = fit_series(df, keys, order, y, pdq, seasonal, period, width)
    return _public(fit_information(fit.rows, fit.keys, "w", "residual", len(fit.ar) + len(fit.ma) + 2))


# --- windowed regressors --------------------------------------------------------------------------------------------------


def window_predictions(
    train: DataFrame, test: DataFrame, keys: list[str], order: list[str], features: list[str], targets: list[str], lookback: int = 5,
    estimator: str = "linear", scaling: str = "minmax", validation: float = 0.15, width: int | None = None, **options,
) -> DataFrame:
    """One step ahead from the previous ``lookback`` rows, one model per target.

    Scaling is fitted on train; the tail of the training windows is the validation part. Windows are built once, with the
    labels of all targets, and stored. Returns (target, split, keys, order, actual, predicted, residual) on the original scale.
    """
    columns = list(dict.fromkeys([*features, *targets]))
    train, test = (df.withColumns({c: clean_non_finite(F.col(c).cast("double")) for c in columns}).na.drop(subset=columns) for df in (train, test))
    scaler = getattr(Scaler, scaling)(train, columns)
    width = width or slice_width(train, keys, order[0])
    place = list(dict.fromkeys([*keys, *order]))

    def windows(df: DataFrame) -> DataFrame:
        ready = scaler.apply(df).select(*place, *[c for c in columns if c not in place], F.struct(*targets).alias("__labels"))
        built = sequence_windows(ready, keys, order, features, lookback, "__labels", width)
        return built.select(*place, array_to_vector(F.flatten("window")).alias("__f"), "label")

    fitting = materialize(split_tail(windows(train), [], order, validation, width))
    parts = {"validation": fitting.filter("is_tail"), "test": materialize(windows(test))}
    out = None
    for target in targets:
        label = F.col("label")[target]
        model = _regressor(estimator, options).fit(fitting.filter(~F.col("is_tail")).select("__f", label.alias("__y")))
        for name, part in parts.items():
            scored = model.transform(part.select(*place, "__f", label.alias("__y"))).select(
                F.lit(target).alias("target"), F.lit(name).alias("split"), *place,
                scaler.invert(F.col("__y"), target).alias("actual"), scaler.invert(F.col("prediction"), target).alias("predicted"),
            )
            out = scored if out is None else out.unionByName(scored)
    return residuals(out, "actual", "predicted")


def window_regressor(
    train: DataFrame, test: DataFrame, keys: list[str], order: list[str], features: list[str], targets: list[str], lookback: int = 5,
    estimator: str = "linear", scaling: str = "minmax", validation: float = 0.15, width: int | None = None, **options,
) -> DataFrame:
    """Errors of ``window_predictions`` as (target, split, mae, mse, rmse, r2); null where a split has no windows."""
    predicted = window_predictions(train, test, keys, order, features, targets, lookback, estimator, scaling, validation, width, **options)
    cases = train.sparkSession.createDataFrame([(t, s) for t in targets for s in ("validation", "test")], "target string, split string")
    return cases.join(regression_metrics(predicted, ["target", "split"], "actual", "predicted"), ["target", "split"], "left")


def _regressor(kind: str, options: dict):
    if kind == "linear":
        return LinearRegression(featuresCol="__f", labelCol="__y", regParam=options.get("ridge", 1e-3))
    return GBTRegressor(
        featuresCol="__f", labelCol="__y", maxIter=options.get("trees", 100), stepSize=options.get("rate", 0.1),
        maxDepth=options.get("depth", 5), seed=options.get("seed", 42),
    )


def hyperparam_pick(train: DataFrame, test: DataFrame, settings: list[dict], **common) -> DataFrame:
    """Validation and test error per setting (lookback, ridge, ...), smallest validation loss first."""
    out = None
    for number, setting in enumerate(settings):
        scores = window_regressor(train, test, **(common | setting))
        wide = scores.groupBy("target").pivot("split", ["validation", "test"]).agg(F.first("mse"))
        text = ",".join(f"{k}={v}" for k, v in sorted(setting.items()))
        row = wide.agg(F.avg("validation").alias("validation_mse"), F.avg("test").alias("test_mse")).select(
            F.lit(number).alias("setting"), F.lit(text).alias("param"), "*"
        )
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.col("validation_mse").asc_nulls_last(), "setting")


def _last_rows(fit: SeriesFit, row: Column, depth: int) -> DataFrame:
    """Last ``depth`` rows per series: ranked inside slices first, so at most ``depth`` rows per slice remain."""
    slices = Slices(fit.rows, fit.keys, fit.order, fit.width)
    kept = slices.df.withColumn("__back", F.row_number().over(slices.local_back)).filter(F.col("__back") <= depth)
    entry = F.struct(*fit.order, row.alias("r"))
    per_slice = kept.groupBy(*slices.group).agg(F.sort_array(F.collect_list(entry)).alias("t"))
    order = slices.across_back
    newest = per_slice.withColumn("__at", F.row_number().over(order)).filter(F.col("__at") <= depth)
    joined = newest.groupBy(*fit.keys).agg(F.sort_array(F.flatten(F.collect_list("t"))).alias("t"))
    return joined.select(*fit.keys, F.when(F.size("t") > depth, F.slice("t", -depth, depth)).otherwise(F.col("t")).alias("t"))

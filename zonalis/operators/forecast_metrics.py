"""Errors of forecasts and comparison of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.operators.rankings import best_per_group

# Comparison metrics, True when larger is better; preferred display order of models.
COMPARED = {"mae": False, "rmse": False, "mse": False, "r2": True}
EPSILON = 2.0 ** -52


def regression_metrics(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """mae, mse, rmse, r2 in one pass; r2 is null when the actual values are constant."""
    error = F.col(actual) - F.col(predicted)
    usable = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    mse = F.avg(error * error)
    r2 = F.when(F.var_pop(actual) > 0, 1 - mse / F.var_pop(actual))
    return usable.groupBy(*keys).agg(F.avg(F.abs(error)).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), r2.alias("r2"))


def mape(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    share = F.abs(F.col(actual) - F.col(predicted)) / F.greatest(F.abs(F.col(actual)), F.lit(EPSILON))
    return df.groupBy(*keys).agg((F.avg(share) * 100).alias("mape"))


def best_model_table(results: DataFrame, metrics: dict[str, bool] = COMPARED) -> DataFrame:
    """Best model per target and metric as rows (target, criterion, model, value): unpivot once, pick once."""
    entries = F.array(*[
        F.struct(F.lit(f"best_{m}").alias("criterion"), F.col(m).alias("value"), (-F.col(m) if larger else F.col(m)).alias("loss"))
        for m, larger in metrics.items()
    ])
    long = results.select("target", "model", F.explode(entries).alias("e")).select("target", "model", "e.*")
    best = best_per_group(long, ["target", "criterion"], "loss", False, ["model"])
    return best.select("target", "criterion", "model", "value").orderBy("target", "criterion")


def model_order(preferred: list[str], model: str = "model") -> list[Column]:
    """Sort keys: preferred models in the given order, the others after them by name."""
    place = F.array_position(F.array(*[F.lit(m) for m in preferred]), F.col(model))
    return [F.when(place > 0, place).otherwise(len(preferred) + 1), F.col(model)]


def order_models(results: DataFrame, preferred: list[str]) -> DataFrame:
    return results.orderBy(*model_order(preferred), "target")

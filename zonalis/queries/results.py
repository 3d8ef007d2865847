"""The model-result table every comparison query starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonalis.plans.adapters import model_results_raw
from zonalis.sources.readers import conform_results


def results(spark: SparkSession, sf: str) -> DataFrame:
    return conform_results(model_results_raw(spark, sf).withColumnsRenamed({"target_raw": "Target", "model_raw": "Model", "r2": "R^2"}))

"""Scoring and ranking of small metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Metric weights of the combined score; True means a larger value is better.
SCORE_WEIGHTS = {"silhouette": (0.4, True), "dbi": (0.3, False), "calinski_harabasz": (0.3, True)}


def minmax_normalize_metrics(df: DataFrame, metrics: dict[str, bool]) -> DataFrame:
    """Each metric scaled to 0..1 over all rows, inverted when smaller is better; 0 where the metric is constant."""
    span = df.agg(*[F.struct(F.min(m).alias("lo"), F.max(m).alias("hi")).alias(m) for m in metrics]).first()
    out = {}
    for metric, larger in metrics.items():
        lo, hi = span[metric]["lo"], span[metric]["hi"]
        if lo is None or hi <= lo:
            out[f"{metric}_norm"] = F.lit(0.0)
        else:
            scaled = (F.col(metric) - lo) / (hi - lo)
            out[f"{metric}_norm"] = scaled if larger else 1 - scaled
    return df.withColumns(out)


def rank_models(df: DataFrame, weights: dict[str, tuple[float, bool]] = SCORE_WEIGHTS, ties: tuple[str, ...] = ("model", "param")) -> DataFrame:
    """Combined score and rank. The window covers a table of trials, one row per setting that was fitted."""
    scaled = minmax_normalize_metrics(df, {m: larger for m, (_, larger) in weights.items()})
    terms = [F.col(f"{m}_norm") * w for m, (w, _) in weights.items()]
    scored = scaled.withColumn("combined_score", sum(terms[1:], terms[0]))
    order = [F.col("combined_score").desc_nulls_last(), *[t for t in ties if t in df.columns]]
    return scored.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def best_per_group(df: DataFrame, group: list[str], metric: str, larger: bool, ties: list[str]) -> DataFrame:
    """The row with the best metric per group, nulls skipped, first by ``ties`` when equal.

    A minimum over (metric, tie-breaks, row) is combined before the shuffle, unlike a row number per group.
    """
    rest = [c for c in df.columns if c not in group]
    key = -F.col(metric) if larger else F.col(metric)
    packed = F.struct(key.alias("__k"), *[F.col(t).alias(f"__t{i}") for i, t in enumerate(ties)], *rest)
    best = df.filter(F.col(metric).isNotNull()).groupBy(*group).agg(F.min(packed).alias("b"))
    return best.select(*group, *[F.col(f"b.{c}").alias(c) for c in rest]).select(*df.columns)


def top_k_by_metric(df: DataFrame, metric: str, k: int = 10, larger: bool = True, ties: tuple[str, ...] = ("model", "param")) -> DataFrame:
    order = F.col(metric).desc_nulls_last() if larger else F.col(metric).asc_nulls_last()
    return df.orderBy(order, *ties).limit(k)


def sort_trials(df: DataFrame, ties: tuple[str, ...] = ("model", "param")) -> DataFrame:
    """Silhouette down with nulls last, noise up, clusters down."""
    return df.orderBy(F.col("silhouette").desc_nulls_last(), F.col("n_outliers").asc(), F.col("n_clusters").desc(), *ties)

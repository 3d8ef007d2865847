"""Equi-joins that attach statistics or labels to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators.aggregates import day_stats, zone_stats
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join


def _attach(train: DataFrame, test: DataFrame, stats: DataFrame, key: str, count: str) -> tuple[DataFrame, DataFrame]:
    """Join the statistics to both splits; test gaps take the mean of the joined training column.

    That mean weighs every group by its training rows, so it follows from the stored table alone and the training
    rows are not read again for it.
    """
    stats = materialize(stats)
    figures = [c for c in stats.columns if c != key]
    weight = F.col(count)
    means = stats.agg(*[(F.sum(F.col(c) * weight) / F.sum(F.when(F.col(c).isNotNull(), weight))).alias(c) for c in figures]).first()
    train, test = (lookup_join(df, stats, [key], null_safe=False, stored=True) for df in (train, test))
    return train, test.withColumns({c: F.coalesce(c, F.lit(means[c])) for c in figures if means[c] is not None})


def attach_zone_stats(train: DataFrame, test: DataFrame, zone: str = "square_id") -> tuple[DataFrame, DataFrame]:
    """Training-zone statistics on both splits; unknown zones of the test split get the training mean."""
    return _attach(train, test, zone_stats(train, zone), zone, "zone_record_count")


def attach_day_stats(train: DataFrame, test: DataFrame, day: str = "day_id") -> tuple[DataFrame, DataFrame]:
    """Training-day statistics on both splits; test days are new by construction and get the training mean."""
    return _attach(train, test, day_stats(train, day), day, "day_record_count")


def join_labels_on_point(df: DataFrame, labels: DataFrame, point: tuple[str, str] = ("latitude", "longitude")) -> DataFrame:
    """Cluster labels back on equal coordinates; a point with several label rows fans out."""
    return lookup_join(df, labels, list(point), null_safe=False)

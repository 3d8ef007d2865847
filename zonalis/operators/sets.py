"""Unions and duplicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal; copies are merged on the map side, so a large group of copies stays small."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame, day: str | None = None) -> DataFrame:
    """Rows that repeat an earlier row, per day or overall."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    extra = F.sum(F.col("__n") - 1).alias("duplicates")
    return copies.groupBy(day).agg(extra) if day else copies.agg(F.coalesce(extra, F.lit(0)).alias("duplicates"))

"""Sorting, limits, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import numeric_columns
from zonalis.plans.slices import Slices


def sort_chronological(df: DataFrame, day: str, ties: list[str]) -> DataFrame:
    """Global order by day (range partitions); rows without a day come last."""
    return df.orderBy(F.col(day).asc_nulls_last(), *ties)


def most_common(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), column).limit(k)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_fraction_by_hash(df: DataFrame, fraction: float, row_id: str, seed: int = 42) -> DataFrame:
    """Sample decided by the row id alone, so the same rows are drawn under any partitioning."""
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), row_id), F.lit(1_000_000)) < int(fraction * 1_000_000))


DRIVER_LIMIT = 10_000


def sample_n(df: DataFrame, n: int, row_id: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows at random, reproducible: the ``n`` smallest hashes of the row id.

    Rows whose hash cannot be among them are filtered where they are read, so about ``4 n`` rows meet for the final cut
    however large the table is. Should too few survive, the filter opens up.
    """
    total, scale = df.count(), 1 << 40
    place = F.pmod(F.xxhash64(F.lit(seed), row_id), F.lit(scale))
    share = min(1.0, 4 * n / max(1, total))
    while share < 1.0 and df.filter(place < int(share * scale)).count() < n:
        share = min(1.0, share * 4)
    near = df.filter(place < int(share * scale)) if share < 1.0 else df
    return near.orderBy(place, row_id).limit(n)


def head_sequential(df: DataFrame, n: int, order: list[str], width: int | None = None) -> DataFrame:
    """First ``n`` rows, sorted; a long head is cut by row position instead of meeting in one task."""
    if n <= DRIVER_LIMIT:
        return df.orderBy(*order).limit(n)
    return Slices(df, [], order, width).numbered("__at").filter(F.col("__at") <= n).orderBy("__at").drop("__at")


def test_days(df: DataFrame, day: str, fraction: float = 0.2) -> list:
    """The last days, at least one, rounded half to even; the list of days is bounded by the calendar."""
    days = sorted(r[0] for r in df.select(day).filter(F.col(day).isNotNull()).distinct().collect())
    return days[len(days) - max(1, round(len(days) * fraction)):] if days else []


def split_by_day(df: DataFrame, day: str = "day_id", fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test by whole days, the last days are the test; rows without a day go to train.

    The split is one comparison with the first test day, which reaches the scan as a pushed filter.
    """
    last = test_days(df, day, fraction)
    if not last:
        return df, df.limit(0)
    is_test = F.coalesce(F.col(day) >= F.lit(last[0]), F.lit(False))
    return df.filter(~is_test), df.filter(is_test)


def split_tail(df: DataFrame, keys: list[str], order: list[str], fraction: float, width: int | None = None) -> DataFrame:
    """Flag ``is_tail``: the last ``int(fraction * n)`` rows of each key in order."""
    out = Slices(df, keys, order, width).numbered("__at", "__n")
    tail = F.floor(F.col("__n") * F.lit(fraction) + F.lit(1e-9)).cast("long")
    return out.withColumn("is_tail", F.col("__at") > F.col("__n") - tail).drop("__at", "__n")


def pick_features_cap(df: DataFrame, cap: int = 16, exclude: list[str] | None = None, by_variance: bool = False) -> list[str]:
    """First ``cap`` numeric columns, or the ones of highest variance."""
    names = numeric_columns(df, exclude)
    if not by_variance or len(names) <= cap:
        return names[:cap]
    row = feature_variances(df, names).collect()
    ranked = sorted(row, key=lambda r: (-(r["variance"] if r["variance"] is not None else -1.0), names.index(r["feature"])))
    return [r["feature"] for r in ranked[:cap]]


def feature_variances(df: DataFrame, names: list[str]) -> DataFrame:
    one = df.agg(*[F.var_samp(c).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in names])).alias("e")).select("e.*")

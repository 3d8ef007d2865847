"""Group statistics, profiles and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import SERVERS, rounded
from zonalis.plans.materialize import materialize
from zonalis.plans.quantiles import HOT_ROWS, column_name, exact_percentiles

# Columns averaged and carried over by the zone rollup.
ROLLUP_MEANS = ["latitude", "longitude", "avg_latency", "std_latency", "total_throughput"]
ROLLUP_FIRST = ["zone_avg_latency", "zone_avg_upload", "zone_avg_download"]


def mean_of(columns: list[Column]) -> Column:
    """Mean of the non-null ones among several columns."""
    present = F.array_compact(F.array(*columns))
    total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(present) > 0, total / F.size(present))


def _group_stats(df: DataFrame, key: str, prefix: str, centre: bool) -> DataFrame:
    """Counts and means per key, one pass; null keys are left out, null figures take the mean over the groups."""
    measures = [F.count(F.lit(1)).alias(f"{prefix}_record_count")]
    measures += [F.avg(c).alias(f"__avg_{c}") for c in SERVERS] + [F.stddev_samp(c).alias(f"__std_{c}") for c in SERVERS]
    measures += [F.avg("upload_mbps").alias(f"{prefix}_avg_upload"), F.avg("download_mbps").alias(f"{prefix}_avg_download")]
    if centre:
        measures += [F.avg("latitude").alias(f"{prefix}_center_lat"), F.avg("longitude").alias(f"{prefix}_center_lon")]
    stats = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*measures)
    stats = stats.withColumns({
        f"{prefix}_avg_latency": mean_of([F.col(f"__avg_{c}") for c in SERVERS]),
        f"{prefix}_std_latency": mean_of([F.col(f"__std_{c}") for c in SERVERS]),
    }).drop(*[f"__{kind}_{c}" for kind in ("avg", "std") for c in SERVERS])
    return stats


def fill_with_column_mean(stored: DataFrame, key: str) -> DataFrame:
    figures = [c for c in stored.columns if c != key]
    means = stored.agg(*[F.avg(c).alias(c) for c in figures]).first()
    return stored.withColumns({c: F.coalesce(c, F.lit(means[c])) for c in figures if means[c] is not None})


def zone_stats(train: DataFrame, zone: str = "square_id") -> DataFrame:
    return fill_with_column_mean(materialize(_group_stats(train, zone, "zone", centre=True)), zone)


def day_stats(train: DataFrame, day: str = "day_id") -> DataFrame:
    return fill_with_column_mean(materialize(_group_stats(train, day, "day", centre=False)), day)


def zone_rollup(df: DataFrame, zone: str = "square_id") -> DataFrame:
    """One row per zone: means, and any value of columns that are constant within a zone."""
    means = [F.avg(c).alias(c) for c in ROLLUP_MEANS if c in df.columns]
    first = [F.min(c).alias(c) for c in ROLLUP_FIRST if c in df.columns]
    return df.filter(F.col(zone).isNotNull()).groupBy(zone).agg(*means, *first)


def bbox_stats(df: DataFrame, zone: str = "square_id") -> DataFrame:
    return df.filter(F.col(zone).isNotNull()).groupBy(zone).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("latitude").alias("lat_min"), F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"), F.max("longitude").alias("lon_max"),
        F.avg("latitude").alias("lat_mean"), F.avg("longitude").alias("lon_mean"),
    )


def time_coverage(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("time_min"), F.max(ts).alias("time_max"))


def value_counts(df: DataFrame, key: Column, name: str, by_frequency: bool = False) -> DataFrame:
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("count")).filter(F.col(name).isNotNull())
    return counts.orderBy(F.col("count").desc(), name) if by_frequency else counts.orderBy(name)


def describe_column(df: DataFrame, column: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """count, mean, std, min, exact quartiles, max as one row."""
    basic = df.agg(
        F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )
    quartiles = exact_percentiles(df, [], [column], [0.25, 0.5, 0.75], hot_rows).first()
    return basic.withColumns({f"p{int(q * 100)}": F.lit(quartiles[column_name(column, q)]) for q in (0.25, 0.5, 0.75)})


def daily_summary(df: DataFrame, day: str = "day_id") -> DataFrame:
    """Per day: rows, mean of the mean latencies, mean of the mean throughputs."""
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("records"),
        mean_of([F.avg(c) for c in SERVERS]).alias("mean_latency"),
        mean_of([F.avg("upload_mbps"), F.avg("download_mbps")]).alias("mean_throughput"),
    )


def hourly_resample(df: DataFrame, columns: list[str], ts: str = "ts", keys: list[str] | None = None) -> DataFrame:
    """Mean of each column per hour; hours in which every column is null are dropped."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("hour_start")
    means = df.filter(F.col(ts).isNotNull()).groupBy(*(keys or []), hour).agg(*[F.avg(c).alias(c) for c in columns])
    return means.na.drop(how="all", subset=columns)


def cluster_profile(df: DataFrame, features: list[str], label: str = "cluster", places: int = 2) -> DataFrame:
    return df.groupBy(label).agg(*[rounded(F.avg(c), places).alias(c) for c in features])


def cluster_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of clusters, noise rows and noise share; sizes are counted per label first."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    noise = F.coalesce(F.sum(F.when(F.col(label) == -1, F.col("n"))), F.lit(0))
    return sizes.agg(
        F.count_if(F.col(label) != -1).alias("n_clusters"), noise.alias("n_outliers"),
        (noise / F.sum("n") * 100).alias("outlier_pct"),
    )


def cluster_sizes(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def metric_matrix(results: DataFrame, metric: str, models: list[str]) -> DataFrame:
    """target x model matrix of one metric; listing the models spares the pass that would look for them."""
    return results.groupBy("target").pivot("model", models).agg(F.first(metric, ignorenulls=True))


def distinct_count(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"{c}_distinct") for c in columns])

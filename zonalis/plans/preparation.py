"""From raw files to feature tables: ingest, clean, split and impute, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.functions import columns as c
from zonalis.functions.predicates import drop_invalid_gps, require_valid_date
from zonalis.operators.imputation import fill_remaining, fill_test_with_train_mean, hierarchical_impute
from zonalis.operators.joins import attach_day_stats, attach_zone_stats
from zonalis.operators.neighbours import knn_impute
from zonalis.operators.ordering import split_by_day
from zonalis.operators.windows import LAGGED, ffill_by_group, fill_group_mean, lag_features
from zonalis.plans.materialize import materialize
from zonalis.plans.numbering import global_index
from zonalis.plans.slices import slice_width
from zonalis.sources.readers import read_csv_glob

LATENCIES = ("svr1", "svr2", "svr3", "svr4")


def ingest(spark: SparkSession, pattern: str) -> DataFrame:
    """All raw files with a day per row; rows without a readable date are dropped when date parts exist."""
    raw = read_csv_glob(spark, pattern)
    if {"year", "month", "date"} <= set(raw.columns):
        raw = require_valid_date(raw)
        raw = raw.withColumn("day_id", c.make_day_id(F.col("year"), F.col("month"), F.col("date")))
    return raw


def clean(raw: DataFrame) -> DataFrame:
    return drop_invalid_gps(c.clean_measurements(raw))


def impute(df: DataFrame, columns: list[str] | None = None, test_fraction: float = 0.2, exclude: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split by day, then fill both splits from training medians."""
    columns = c.columns_to_impute(df, exclude) if columns is None else columns
    train, test = split_by_day(df, "day_id", test_fraction)
    return hierarchical_impute(train, test, columns) if columns else (train, test)


def refine(train: DataFrame, test: DataFrame, row_id: str, k: int = 5, columns: tuple[str, ...] = LATENCIES) -> tuple[DataFrame, DataFrame]:
    """Latencies still missing in either split take the mean of the ``k`` nearest training rows; nothing is done without gaps."""
    block = [n for n in columns if n in train.columns]
    if not block:
        return train, test
    gap = F.greatest(*[F.col(n).isNull().cast("int") for n in block], F.lit(0)) == 1
    donors, test = materialize(train), materialize(test)  # both are read several times
    return tuple(
        df if df.filter(gap).isEmpty() else knn_impute(donors, df, row_id, block, k) for df in (donors, test)
    )


def impute_flow(
    df: DataFrame, row_id: str | None = None, columns: list[str] | None = None, test_fraction: float = 0.2,
    exclude: list[str] | None = None, neighbours: int | None = 5,
) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Day key, split by day, training medians, refinement of the latencies by neighbours: (train, test, both, columns).

    ``row_id`` is a whole number that no two rows share; without one, rows are numbered for the refinement. ``both`` holds the
    rows of train and test, whose days are later. ``neighbours=None`` leaves the refinement out.
    """
    df = c.derive_date_key(df)
    columns = c.columns_to_impute(df, [*(exclude or []), *([row_id] if row_id else [])]) if columns is None else columns
    number = row_id
    if neighbours and number is None:
        number = "__row"
        df = global_index(df, ["date_key"], number)
    train, test = split_by_day(df, "date_key", test_fraction)
    if columns:
        train, test = hierarchical_impute(train, test, columns, day="date_key")
    if neighbours:
        train, test = (d if row_id else d.drop(number) for d in refine(train, test, number, neighbours))
    return train, test, train.unionByName(test), columns


def row_features(df: DataFrame) -> DataFrame:
    df = c.throughput_features(c.row_stats(c.time_features(df)))
    df = df.withColumns({
        "time_of_day": c.time_of_day_bucket(F.col("hour")),
        "is_peak_hours": c.is_peak_hours(F.col("hour")),
        "latency_quality": c.latency_quality(F.col("avg_latency")),
        "throughput_quality": c.throughput_quality(F.col("total_throughput")),
    })
    return c.location_hash(df)


def lagged(train: DataFrame, test: DataFrame, order: list[str], zone: str = "square_id") -> tuple[DataFrame, DataFrame]:
    """Lags per split; training gaps by forward fill then zone mean, test gaps by the training mean."""
    names = [f"{n}_lag1" for n in LAGGED]
    width = slice_width(train, [zone], order[0])
    train, test = (lag_features(df, [zone], order, width=width) for df in (train, test))
    train = materialize(fill_group_mean(materialize(ffill_by_group(train, [zone], order, names, width)), zone, names))
    return train, materialize(fill_test_with_train_mean(train, test, names))


def build_features(train: DataFrame, test: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Row features, day and zone statistics, lags, remaining gaps.

    Everything before the lags is projection and broadcast lookups on the stored input, cheaper to repeat than to
    write; the ordered part is the expensive one and is stored.
    """
    train, test = attach_day_stats(row_features(train), row_features(test))
    train, test = attach_zone_stats(train, test)
    out = []
    for df in lagged(train, test, order):
        numeric = c.numeric_columns(df, ["latitude", "longitude"])
        text = [n for n, t in df.dtypes if t == "string" and n != "square_id"]
        out.append(fill_remaining(df, numeric, text))
    return out[0], out[1]


def prepare(spark: SparkSession, pattern: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Files to feature tables; the cleaned and the imputed rows are stored, as later stages read them several times."""
    cleaned = materialize(clean(ingest(spark, pattern)))
    train, test = impute(cleaned)
    return build_features(materialize(train), materialize(test), order)

"""Data-quality reports, each in one pass over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import SERVERS, null_counts, numeric_columns, parse_number
from zonalis.functions.predicates import column_value_spread, gps_out_of_range
from zonalis.operators.windows import zscore_outliers


def _counted(df: DataFrame, flag: Column, name: str, day: str | None) -> DataFrame:
    measure = F.coalesce(F.sum(flag), F.lit(0)).cast("long").alias(name)
    return df.groupBy(day).agg(measure) if day else df.agg(measure)


def invalid_gps_report(df: DataFrame, day: str | None = None) -> DataFrame:
    return _counted(df, gps_out_of_range().cast("int"), "invalid_gps", day)


def negative_value_report(df: DataFrame, latency: list[str] = SERVERS, throughput: tuple[str, ...] = ("upload_mbps", "download_mbps"), day: str | None = None) -> DataFrame:
    """Negative cells among latency and throughput columns."""
    def cells(columns) -> Column:
        flags = [F.coalesce((F.col(c) < 0).cast("int"), F.lit(0)) for c in columns]
        return F.coalesce(F.sum(sum(flags[1:], flags[0])), F.lit(0)).cast("long")

    measures = [cells(latency).alias("negative_latency"), cells(throughput).alias("negative_throughput")]
    return df.groupBy(day).agg(*measures) if day else df.agg(*measures)


def missing_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return null_counts(df, columns or df.columns)


def type_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values per column that are present but do not parse as a number."""
    one = df.agg(*[F.count_if(F.col(c).isNotNull() & parse_number(F.col(c)).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("not_numeric")) for c in columns])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def constant_column_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Numeric columns with at most one distinct value; minimum against maximum needs no set of values."""
    return column_value_spread(df, columns or numeric_columns(df)).filter("constant").select("column_name")


def outlier_report(df: DataFrame, columns: list[str], day: str | None = None) -> DataFrame:
    return _counted(zscore_outliers(df, columns, by=day), F.col("is_outlier").cast("int"), "outliers", day)

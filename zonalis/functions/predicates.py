"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.functions.columns import parse_number

# Coordinates that mean "no fix".
INVALID_COORDINATES = [0.0, 99.999, 99.9999, 999.0, 999.999]
UNKNOWN_ZONE = "Unknown"
NOISE = -1


def drop_invalid_gps(df: DataFrame) -> DataFrame:
    """Remove rows whose latitude or longitude is a no-fix value; rows with null coordinates stay."""
    def bad(name: str) -> Column:
        value = F.col(name) if dict(df.dtypes)[name] == "double" else parse_number(F.col(name))
        return F.coalesce(value.isin(INVALID_COORDINATES), F.lit(False))

    return df.filter(~bad("latitude") & ~bad("longitude"))


def require_valid_date(df: DataFrame, year: str = "year", month: str = "month", day: str = "date") -> DataFrame:
    return df.filter(
        parse_number(F.col(year)).isNotNull() & parse_number(F.col(month)).isNotNull() & parse_number(F.col(day)).isNotNull()
    )


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=subset)


def split_known_unknown(df: DataFrame, zone: str = "square_id") -> tuple[DataFrame, DataFrame]:
    known = (F.col(zone) != UNKNOWN_ZONE) & F.col(zone).isNotNull()
    return df.filter(known), df.filter(~F.coalesce(known, F.lit(False)))


def filter_models(df: DataFrame, models: list[str]) -> DataFrame:
    return df.filter(F.col("model").isin(models))


def mask_noise(df: DataFrame, label: str = "label") -> DataFrame:
    return df.filter(F.col(label) != NOISE)


def column_value_spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, non_null, constant) in one pass: a column varies exactly if its minimum and maximum differ."""
    one = df.agg(*[
        F.struct(F.count(c).alias("n"), (F.min(c) != F.max(c)).alias("varies")).alias(c) for c in columns
    ])
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"{c}.n").alias("non_null"),
            (~F.coalesce(F.col(f"{c}.varies"), F.lit(False))).alias("constant"),
        ) for c in columns
    ])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def drop_sparse_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are empty or hold a single value."""
    drop = [r[0] for r in column_value_spread(df, df.columns).filter("constant").collect()]
    return df.drop(*drop)


def gps_out_of_range(latitude: Column = None, longitude: Column = None) -> Column:
    """True for coordinates outside the globe; null coordinates are not flagged."""
    lat = F.col("latitude") if latitude is None else latitude
    lon = F.col("longitude") if longitude is None else longitude
    return ~F.coalesce(lat.between(-90, 90), F.lit(True)) | ~F.coalesce(lon.between(-180, 180), F.lit(True))

"""Leakage-safe hierarchical imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize
from zonalis.plans.quantiles import HOT_ROWS, column_name, counted_medians, exact_percentiles
from zonalis.plans.skew import lookup_join

LEVELS = ("zone_day", "zone", "day")


def medians_by(df: DataFrame, keys: list[str], columns: list[str], hot_rows: int = HOT_ROWS, total: int | None = None) -> DataFrame:
    out = exact_percentiles(df, keys, columns, [0.5], hot_rows, total)
    return out.withColumnsRenamed({column_name(c, 0.5): c for c in columns})


def group_medians(
    train: DataFrame, columns: list[str], zone: str = "square_id", day: str = "day_id", hot_rows: int = HOT_ROWS
) -> dict[str, DataFrame]:
    """Exact medians of the training rows per (zone, day), zone, day and overall (null keys form groups).

    The rows are read once: equal values of a (zone, day) are counted before the shuffle, and the stored counts are added up
    for the coarser levels.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    opened = train.select(F.col(zone).alias("zone"), F.col(day).alias("day"), F.explode(entries).alias("e")).select("zone", "day", "e.column", "e.v")
    counts = materialize(opened.groupBy("zone", "day", "column", "v").agg(F.count(F.lit(1)).alias("times")))
    total = counts.count()
    out = {}
    for level, by in {"zone_day": ["zone", "day"], "zone": ["zone"], "day": ["day"], "global": []}.items():
        part = counts if level == "zone_day" else counts.groupBy(*by, "column", "v").agg(F.sum("times").alias("times"))
        medians = counted_medians(part.filter("v IS NOT NULL"), [*by, "column"], hot_rows, total)
        # a group without any value still has a row of nulls
        groups = counts.select(*by, F.lit(-1).alias("column"), F.lit(None).cast("double").alias("value")).distinct()
        wide = groups.unionByName(medians).groupBy(*by).agg(*[F.max(F.when(F.col("column") == i, F.col("value"))).alias(c) for i, c in enumerate(columns)])
        out[level] = wide.withColumnsRenamed({"zone": zone, "day": day})
    return out


def fill_from_level(df: DataFrame, keys: list[str], medians: DataFrame, columns: list[str], stored: bool = False) -> DataFrame:
    """Fill null cells from the group value; cells that have a value are kept."""
    level = medians.select(*keys, *[F.col(c).alias(f"__m_{c}") for c in columns])
    joined = lookup_join(df, level, keys, stored=stored)
    return joined.withColumns({c: F.coalesce(c, F.col(f"__m_{c}")) for c in columns}).drop(*[f"__m_{c}" for c in columns])


def hierarchical_impute(
    train: DataFrame, test: DataFrame, columns: list[str], zone: str = "square_id", day: str = "day_id", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Zone-day, zone, day, then overall medians, all taken from the training rows and stored once for both splits."""
    medians = {level: materialize(table) for level, table in group_medians(train, columns, zone, day, hot_rows).items()}
    overall = medians["global"].first()
    keys = {"zone_day": [zone, day], "zone": [zone], "day": [day]}

    def fill(df: DataFrame) -> DataFrame:
        for level in LEVELS:
            df = fill_from_level(df, keys[level], medians[level], columns, stored=True)
        return df.withColumns({c: F.coalesce(c, F.lit(overall[c])) for c in columns if overall[c] is not None})

    return fill(train), fill(test)


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent non-null value of every column that has one, the smallest on a tie; one pass, counted before the shuffle."""
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("v")) for c in columns])
    counted = df.select(F.explode(entries).alias("e")).filter("e.v IS NOT NULL").groupBy("e.name", "e.v").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v"))
    return {r["name"]: r["v"] for r in best.collect()}  # a row per column


def fill_remaining(
    df: DataFrame, numeric: list[str], categorical: list[str], default: str = "unknown", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Numeric nulls from the column median, categorical nulls from the mode, ``default`` where there is none.

    One pass tells which columns have nulls; only their medians and modes are worked out.
    """
    named = [*dict.fromkeys([*numeric, *categorical])]
    if named:
        lacking = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in named]).first()
        numeric, categorical = ([c for c in part if lacking[c]] for part in (numeric, categorical))
    values = {}
    if numeric:
        medians = exact_percentiles(df, [], numeric, [0.5], hot_rows).first()
        values |= {c: medians[column_name(c, 0.5)] for c in numeric}
    modes = most_frequent(df, categorical) if categorical else {}
    values |= {c: modes.get(c, default) for c in categorical}
    return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in values.items() if v is not None})


def fill_test_with_train_mean(train: DataFrame, test: DataFrame, columns: list[str]) -> DataFrame:
    """Null test cells take the mean of the same column over the training rows."""
    means = train.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return test.withColumns({c: F.coalesce(c, F.lit(means[c])) for c in columns if means[c] is not None})

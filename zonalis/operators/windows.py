"""Ordered operators over zones or whole series, built on slices so that no key has to fit one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join
from zonalis.plans.slices import Slices

LAGGED = ["avg_latency", "upload_mbps", "download_mbps"]


def lag_features(df: DataFrame, keys: list[str], order: list[str], columns: list[str] = LAGGED, width: int | None = None) -> DataFrame:
    """Previous row's value of each column per key; rows without a key get null."""
    return Slices(df, keys, order, width).lags({f"{c}_lag1": (F.col(c), 1) for c in columns})


def ffill_by_group(df: DataFrame, keys: list[str], order: list[str], columns: list[str], width: int | None = None) -> DataFrame:
    return Slices(df, keys, order, width).fill(columns, forward=True)


def fill_group_mean(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Null cells take the mean of their group; the means are combined map-side and joined, not windowed."""
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    joined = lookup_join(df, means, [key], null_safe=False)
    return joined.withColumns({c: F.coalesce(c, F.col(f"__m_{c}")) for c in columns}).drop(*[f"__m_{c}" for c in columns])


def interpolate_series(df: DataFrame, keys: list[str], order: list[str], column: str, width: int | None = None) -> DataFrame:
    """Linear by row position between the nearest known values; ends take the nearest known value."""
    finite = F.when(~F.isnan(column) & (F.abs(column) != float("inf")), F.col(column))
    slices = Slices(df.withColumn(column, finite), keys, order, width)
    local, across = slices.local, slices.across
    known = F.col(column).isNotNull()
    summary = slices.summary(__n=F.count(F.lit(1)))
    before = F.coalesce(F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = summary.select(*slices.group, before.alias("__before"))
    numbered = slices.attach(offsets).withColumn("__at", F.col("__before") + F.row_number().over(local))
    edge = numbered.groupBy(*slices.group).agg(
        F.max(F.when(known, F.struct("__at", F.col(column).alias("v")))).alias("tail"),
        F.min(F.when(known, F.struct("__at", F.col(column).alias("v")))).alias("head"),
    )
    edge = edge.select(
        *slices.group,
        F.last("tail", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
        F.last("head", ignorenulls=True).over(slices.across_back.rowsBetween(Window.unboundedPreceding, -1)).alias("__ahead"),
    )
    here = F.when(known, F.struct("__at", F.col(column).alias("v")))
    joined = numbered.join(edge, slices.group, "left").withColumn("__here", here)
    back = F.coalesce(F.last("__here", ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0)), "__carry")
    ahead = F.coalesce(F.last("__here", ignorenulls=True).over(slices.local_back.rowsBetween(Window.unboundedPreceding, 0)), "__ahead")
    joined = joined.withColumns({"__p": back, "__q": ahead})
    share = (F.col("__at") - F.col("__p.__at")) / (F.col("__q.__at") - F.col("__p.__at"))
    line = F.col("__p.v") + (F.col("__q.v") - F.col("__p.v")) * share
    value = (
        F.when(known, F.col(column)).when(F.col("__p").isNull(), F.col("__q.v")).when(F.col("__q").isNull(), F.col("__p.v")).otherwise(line)
    )
    return joined.withColumn(column, value).select(*df.columns)


def consecutive_diff(df: DataFrame, order: list[str], into: str = "time_diff_sec", keys: list[str] | None = None, width: int | None = None) -> DataFrame:
    """Seconds since the previous record in time order; null for the first."""
    ts = order[0]
    lagged = Slices(df, keys or [], order, width).lags({"__prev": (F.col(ts), 1)})
    micros = F.expr(f"timestampdiff(MICROSECOND, __prev, `{ts}`)")
    return lagged.withColumn(into, micros / F.lit(1e6)).drop("__prev")


def sequence_windows(df: DataFrame, keys: list[str], order: list[str], features: list[str], lookback: int, target: str, width: int | None = None) -> DataFrame:
    """For every row with ``lookback`` predecessors: their feature rows, oldest first, and the row's own target."""
    row = F.array(*[F.col(c).cast("double") for c in features])
    out = Slices(df, keys, order, width).previous_rows(row, lookback, "window")
    return out.filter(F.size("window") == lookback).withColumn("label", F.col(target))


def zscore_outliers(df: DataFrame, columns: list[str], by: str | None = None, limit: float = 3.0) -> DataFrame:
    """z per column over the table or per group, and a flag for rows with any |z| above ``limit``."""
    measures = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(f"__s_{c}") for c in columns]
    if by:
        joined = lookup_join(df, df.groupBy(by).agg(*measures), [by])
    else:
        row = df.agg(*measures).first()
        joined = df.withColumns({
            f"__s_{c}": F.struct(F.lit(row[f"__s_{c}"]["mean"]).alias("mean"), F.lit(row[f"__s_{c}"]["sd"]).alias("sd")) for c in columns
        })
    joined = joined.withColumns({
        f"{c}_z": F.when(F.col(f"__s_{c}.sd") > 0, (F.col(c) - F.col(f"__s_{c}.mean")) / F.col(f"__s_{c}.sd")) for c in columns
    })
    extreme = F.greatest(*[F.coalesce(F.abs(f"{c}_z"), F.lit(0.0)) for c in columns], F.lit(0.0))
    return joined.withColumn("is_outlier", extreme > limit).drop(*[f"__s_{c}" for c in columns])


def difference_series(
    df: DataFrame, keys: list[str], order: list[str], column: str, d: int = 1, seasonal: int = 0, period: int = 24, width: int | None = None
) -> DataFrame:
    """d-th regular and D-th seasonal difference as one weighted sum of lags, so the rows are ordered once."""
    weights = difference_weights(d, seasonal, period)
    lags = {f"__l{k}": (F.col(column), k) for k in weights if k > 0}
    out = Slices(df, keys, order, width).lags(lags) if lags else df
    terms = [F.col(column) * weights[0]] + [F.col(f"__l{k}") * w for k, w in weights.items() if k > 0]
    return out.withColumn(f"{column}_diff", sum(terms[1:], terms[0])).drop(*lags)


def difference_weights(d: int, seasonal: int = 0, period: int = 24) -> dict[int, float]:
    """Coefficients of (1 - B)^d (1 - B^period)^D by lag."""
    weights = {0: 1.0}
    for step in [1] * d + [period] * seasonal:
        shifted: dict[int, float] = {}
        for k, w in weights.items():
            shifted[k] = shifted.get(k, 0.0) + w
            shifted[k + step] = shifted.get(k + step, 0.0) - w
        weights = shifted
    return {k: w for k, w in weights.items() if w or k == 0}


def rolling_mean(df: DataFrame, keys: list[str], order: list[str], column: str, n: int, into: str, width: int | None = None) -> DataFrame:
    """Mean of the non-null values among the previous ``n`` rows of the key; null for rows with a null key.

    A key's rows are cut into blocks of ``n``. The previous ``n`` rows are the end of one block and the start of the next, so
    running sums from both ends of each block give every mean from two numbers, without subtracting and without arrays.
    """
    named = {k: f"__k{i}" for i, k in enumerate(keys)}
    numbered = Slices(df, keys, order, width).numbered("__at").withColumn("__at", F.col("__at") - 1)
    numbered = materialize(numbered.withColumn("__block", F.floor(F.col("__at") / n)))
    block = Window.partitionBy(*keys, "__block")
    value, count = F.coalesce(F.col(column).cast("double"), F.lit(0.0)), F.col(column).isNotNull().cast("long")
    before = block.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    onward = block.orderBy(F.col("__at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = numbered.withColumns({"__s": F.coalesce(F.sum(value).over(before), F.lit(0.0)), "__c": F.coalesce(F.sum(count).over(before), F.lit(0))})
    ends = numbered.select(*[F.col(k).alias(a) for k, a in named.items()], (F.col("__at") + n).alias("__to"), F.sum(value).over(onward).alias("__t"), F.sum(count).over(onward).alias("__d"))
    # Early rows have nothing n rows before them; their block holds all there is.
    met = rows.join(ends, [*[F.col(k).eqNullSafe(F.col(a)) for k, a in named.items()], F.col("__at") == F.col("__to")], "left")
    total, known = F.col("__s") + F.coalesce("__t", F.lit(0.0)), F.col("__c") + F.coalesce("__d", F.lit(0))
    mean = F.when(known > 0, total / known)
    for k in keys:
        mean = F.when(F.col(k).isNotNull(), mean)
    return met.withColumn(into, mean).drop("__at", "__block", "__s", "__c", "__to", "__t", "__d", *named.values())

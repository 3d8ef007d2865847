"""Exact percentiles for groups of any size.

Ordinary groups use the built-in ``percentile``. It keeps every distinct value of a group in one buffer, so groups
above ``HOT_ROWS`` are solved by narrowing: each round counts values in equal-width buckets between the current bounds
(a map-side-combined count, no value is shuffled), keeps the bucket that holds the wanted rank, and takes that
bucket's own minimum and maximum as the next bounds until both are equal. Infinities and NaN are no bucket's business:
they are counted, -inf ranks below and inf, then NaN above all finite values, as in the built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join

HOT_ROWS = 200_000
BUCKETS = 4096


def column_name(column: str, q: float) -> str:
    return f"{column}_p{q:g}".replace(".", "_")


def exact_percentiles(
    df: DataFrame, keys: list[str], columns: list[str], probabilities: list[float], hot_rows: int = HOT_ROWS, total: int | None = None
) -> DataFrame:
    """One row per group with ``<column>_p<q>`` (linear interpolation, nulls skipped).

    ``total`` is the number of rows when the caller knows it; a table below ``hot_rows`` cannot have a hot group.
    """
    narrow = df.select(*keys, *columns)

    def builtin(part: DataFrame) -> DataFrame:
        # One aggregate per column: all its percentiles share one buffer of values.
        wanted = [float(q) for q in probabilities]
        found = part.groupBy(*keys).agg(*[F.percentile(F.col(c), wanted).alias(f"__p_{c}") for c in columns])
        return found.select(*keys, *[F.get(f"__p_{c}", F.lit(i)).alias(column_name(c, q)) for c in columns for i, q in enumerate(probabilities)])

    if (narrow.count() if total is None else total) <= hot_rows:
        return builtin(narrow)
    if not keys:
        return _narrowing(narrow.withColumn("__all", F.lit(0)), ["__all"], columns, probabilities).drop("__all")
    sizes = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > hot_rows)
    hot = materialize(sizes.select(*keys, F.lit(True).alias("__hot")))
    if hot.isEmpty():
        return builtin(narrow)
    marked = lookup_join(narrow, hot, keys, stored=True)
    ordinary = builtin(marked.filter(F.col("__hot").isNull()))
    return ordinary.unionByName(_narrowing(marked.filter("__hot").drop("__hot"), keys, columns, probabilities))


def _narrowing(df: DataFrame, keys: list[str], columns: list[str], probabilities: list[float]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns])
    values = df.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.name", "e.v", F.lit(1).alias("times")).filter(F.col("v").isNotNull())
    known = narrowed(values, [*keys, "name"], probabilities).groupBy(*keys).agg(*[
        F.max(F.when((F.col("name") == c) & (F.col("q") == float(q)), F.col("value"))).alias(column_name(c, q)) for c in columns for q in probabilities
    ])
    return lookup_join(df.select(*keys).distinct(), known, keys)


def narrowed(values: DataFrame, group: list[str], probabilities: list[float]) -> DataFrame:
    """(group, q, value) of values (group, v, times) by narrowing; ``times`` is how often a value counts."""
    v = F.col("v")
    finite = ~F.isnan("v") & (v > F.lit(float("-inf"))) & (v < F.lit(float("inf")))

    def times(condition) -> Column:
        return F.sum(F.when(condition, F.col("times")).otherwise(0))

    bounds = values.groupBy(*group).agg(
        F.sum("times").alias("n"), times(v == F.lit(float("-inf"))).alias("lowest"), times(F.isnan("v")).alias("nans"),
        times(finite).alias("finite"), F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi"),
    )
    wanted = F.array(
        *[F.struct(F.lit(float(q)).alias("q"), F.lit(upper).alias("upper")) for q in probabilities for upper in (False, True)]
    )
    place = F.col("w.q") * (F.col("n") - 1)
    rank = F.when(F.col("w.upper"), F.ceil(place)).otherwise(F.floor(place)).cast("long")
    special = (
        F.when(rank < F.col("lowest"), F.lit(float("-inf")))
        .when(rank >= F.col("n") - F.col("nans"), F.lit(float("nan")))
        .when(rank >= F.col("lowest") + F.col("finite"), F.lit(float("inf")))
    )
    state = bounds.withColumn("w", F.explode(wanted)).select(
        *group, F.col("w.q").alias("q"), F.col("w.upper").alias("upper"), place.alias("place"), rank.alias("rank"),
        F.col("lowest").alias("below"), F.coalesce(special, "lo").alias("lo"), F.coalesce(special, "hi").alias("hi"),
    )
    state = materialize(state)
    found = state.filter(F.col("lo") == F.col("hi"))
    open_ = state.filter(F.col("lo") < F.col("hi"))
    done = [found]
    while not open_.isEmpty():
        open_ = materialize(_narrow_once(values, open_, group))
        done.append(open_.filter(F.col("lo") == F.col("hi")))
        open_ = open_.filter(F.col("lo") < F.col("hi"))
    solved = done[0]
    for part in done[1:]:
        solved = solved.unionByName(part)
    pairs = solved.groupBy(*group, "q").agg(
        F.max("place").alias("place"),
        F.max(F.when(~F.col("upper"), F.col("lo"))).alias("a"),
        F.max(F.when(F.col("upper"), F.col("lo"))).alias("b"),
    )
    part = F.col("place") - F.floor("place")
    value = F.when((part == 0) | (F.col("a") == F.col("b")), F.col("a")).otherwise(F.col("a") * (1 - part) + F.col("b") * part)
    return pairs.select(*group, "q", value.alias("value"))


def _narrow_once(values: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """Replace every open bound by the extent of the bucket that contains its rank."""
    packed = state.groupBy(*group).agg(F.collect_list(F.struct("q", "upper", "place", "rank", "below", "lo", "hi")).alias("open"))
    inside = lookup_join(values, packed, group).withColumn("s", F.explode("open")).filter(
        (F.col("v") >= F.col("s.lo")) & (F.col("v") <= F.col("s.hi"))
    )
    share = (F.col("v") / 2 - F.col("s.lo") / 2) / (F.col("s.hi") / 2 - F.col("s.lo") / 2)  # halves: no span overflows
    bucket = F.least(F.floor(share * BUCKETS).cast("long"), F.lit(BUCKETS - 1))
    counted = inside.groupBy(*group, "s", bucket.alias("bucket")).agg(
        F.sum("times").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    order = Window.partitionBy(*group, "s").orderBy("bucket")
    reach = F.col("s.below") + F.sum("n").over(order)
    hit = counted.withColumn("reach", reach).filter(
        (F.col("reach") > F.col("s.rank")) & (F.col("reach") - F.col("n") <= F.col("s.rank"))
    )
    return hit.select(
        *group, F.col("s.q").alias("q"), F.col("s.upper").alias("upper"), F.col("s.place").alias("place"),
        F.col("s.rank").alias("rank"), (F.col("reach") - F.col("n")).alias("below"), "lo", "hi",
    )


def counted_medians(counts: DataFrame, group: list[str], hot_rows: int = HOT_ROWS, total: int | None = None) -> DataFrame:
    """(group, value): medians of counted values (group, v, times), each value once per group.

    A running count over a group's distinct values finds the middle ranks; groups with more than ``hot_rows`` of them are
    narrowed instead.
    """
    def running(part: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*group)
        ranked = part.withColumns({"__to": F.sum("times").over(whole.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), "__n": F.sum("times").over(whole)})
        low, high = F.floor((F.col("__n") - 1) / 2), F.ceil((F.col("__n") - 1) / 2)

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("__to") > rank) & (F.col("__to") - F.col("times") <= rank), F.col("v")))

        found = ranked.groupBy(*group).agg(at(low).alias("a"), at(high).alias("b"))
        return found.select(*group, F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") * 0.5 + F.col("b") * 0.5).alias("value"))

    if total is not None and total <= hot_rows:
        return running(counts)
    hot = counts.groupBy(*group).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > hot_rows)
    hot = materialize(hot.select(*group, F.lit(True).alias("__hot")))
    if hot.isEmpty():
        return running(counts)
    marked = lookup_join(counts, hot, group, stored=True)
    return running(marked.filter(F.col("__hot").isNull())).unionByName(narrowed(marked.filter("__hot").drop("__hot"), group, [0.5]).drop("q"))

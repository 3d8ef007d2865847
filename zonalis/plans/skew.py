"""Joins of a fact table with a table that is unique per key, safe for hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.plans.materialize import BROADCAST_BYTES, fits_broadcast, materialize

HOT_SHARE = 500
SALTS = 64


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def hot_keys(df: DataFrame, keys: list[str], share: int = HOT_SHARE, floor: int = 100_000) -> DataFrame:
    """Keys that hold more than ``1/share`` of all rows: never more than ``share`` of them, whatever the data size."""
    counts = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key")))
    total = counts.agg(F.sum("rows_of_key")).first()[0] or 0
    return counts.filter(F.col("rows_of_key") > max(total // share, floor)).select(*keys)


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    row_id: str | None = None,
    limit: int = BROADCAST_BYTES,
    hot_floor: int = 100_000,
    stored: bool = False,
) -> DataFrame:
    """Left join ``table`` (unique per ``keys``) to ``df``.

    The table is stored first. If its files are within ``limit`` it is broadcast and ``df`` is not shuffled at all.
    Otherwise both sides are shuffled, rows of hot keys are spread over ``SALTS`` sub-keys and only those table rows
    are repeated, so no task receives a whole hot key.
    """
    table = table if stored else materialize(table)
    renamed = {k: f"__{k}" for k in keys}
    right = table.withColumnsRenamed(renamed)

    def matches() -> list[Column]:
        return [F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r) for k, r in renamed.items()]

    if fits_broadcast(table, limit):
        return df.join(F.broadcast(right), all_of(matches()), "left").drop(*renamed.values())

    hot = hot_keys(df, keys, floor=hot_floor).withColumn("__hot", F.lit(True)).withColumnsRenamed(renamed)
    spread = [row_id] if row_id else df.columns
    salted = (
        df.join(F.broadcast(hot), all_of(matches()), "left")
        .drop(*renamed.values())
        .withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*spread), F.lit(SALTS))).otherwise(F.lit(0)))
        .drop("__hot")
    )
    hot_right = hot.withColumnsRenamed({r: f"{r}_h" for r in renamed.values()})
    repeated = (
        right.join(F.broadcast(hot_right), all_of([F.col(r).eqNullSafe(F.col(f"{r}_h")) for r in renamed.values()]), "left")
        .withColumn("__salt_r", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        .drop("__hot", *[f"{r}_h" for r in renamed.values()])
    )
    joined = salted.join(repeated, all_of([*matches(), F.col("__salt") == F.col("__salt_r")]), "left")
    return joined.drop("__salt", "__salt_r", *renamed.values())

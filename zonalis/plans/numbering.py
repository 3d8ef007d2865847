"""Consecutive numbers along a global order without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize


def global_index(df: DataFrame, order: list, into: str) -> DataFrame:
    """Add the 0-based position of each row in ``order``.

    The rows are range-partitioned and stored once with a per-partition number; the partition sizes (one row per
    partition) give the offsets.
    """
    stored = materialize(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("__mid"), 33)
    sizes = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__before"))
    joined = stored.withColumn("__part", part).join(F.broadcast(offsets), "__part", "left")
    return joined.withColumn(into, (F.col("__before") + F.col("__mid").bitwiseAND((1 << 33) - 1)).cast("long")).drop("__mid", "__part", "__before")

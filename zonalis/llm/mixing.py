"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Sources get targets that share a total by weight; a target stops at
``MAX_REPEAT`` times its source's size and what is over is shared again by weight until none is above. A source is then
filled to its target with whole documents:

1. Documents are counted by exact size, so a source becomes a histogram (size, number of documents).
2. Every document is taken as often as the target holds the whole source; the rest is a budget smaller than the source.
3. Of each size the same share is taken, rounded down, which leaves a budget of a few documents' words. A bounded-knapsack
   dynamic program over the documents left of each size fits it exactly, or as nearly as sizes allow, from below.
4. Of each size the wanted number of documents is selected in the order of a seeded hash.

The dynamic program runs per source on histogram rows, never on documents, and with a table bounded by ``DP_CELLS``.
Null texts have size 0; documents of size 0 take no words. Null sources are a source of their own. Rows with equal ids
are separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import fits_broadcast, materialize

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SPACES = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MAX_REPEAT = 2
SEED = 20240611
DP_CELLS = 1 << 16
BUCKET_ROWS = 20_000


def word_count(text: str) -> F.Column:
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, 0).otherwise(F.size(F.split(trimmed, SPACES, -1))).cast("long")


def share_out(sizes: list[int], weights: list[float], total: float, repeat: float = MAX_REPEAT) -> list[float]:
    """Targets that add up to ``total`` by weight, none above ``repeat`` times its size."""
    targets, is_open = [0.0] * len(sizes), [True] * len(sizes)
    left = float(total)
    while any(is_open):
        weight = sum(w for w, o in zip(weights, is_open, strict=True) if o)
        over = [i for i, o in enumerate(is_open) if o and left * weights[i] / weight > repeat * sizes[i]]
        if not over:
            for i, o in enumerate(is_open):
                if o:
                    targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i], is_open[i] = float(repeat * sizes[i]), False
        left = total - sum(t for t, o in zip(targets, is_open, strict=True) if not o)
    return targets


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int, cells: int = DP_CELLS) -> np.ndarray:
    """How many documents of each size to take so that their words come to ``budget`` or as near below as they can.

    An equal share of each size is taken first, rounded down; then the largest that fit, while the rest is above
    ``cells``; then the rest is a bounded knapsack: reach[v] says which size last led to the sum v.
    """
    take = np.zeros(len(sizes), np.int64)
    real = np.flatnonzero(sizes > 0)
    total = int((sizes[real] * counts[real]).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        take[real] = counts[real]
        return take
    for i in real:
        take[i] = int(counts[i]) * budget // total
    left = budget - int((sizes * take).sum())
    for i in real[np.argsort(-sizes[real], kind="stable")]:
        if left < cells:
            break
        more = min(int(counts[i] - take[i]), (left - cells) // int(sizes[i]) + 1, left // int(sizes[i]))
        take[i] += more
        left -= more * int(sizes[i])
    spare = counts - take
    reach = np.full(left + 1, -1, np.int64)  # index of the size whose copies ended at this sum
    used = np.zeros(left + 1, np.int64)
    reach[0] = len(sizes)
    for i in real[np.argsort(sizes[real], kind="stable")]:
        s, n = int(sizes[i]), min(int(spare[i]), left // int(sizes[i]))
        if n <= 0 or reach[left] >= 0:
            continue
        # Sums first reached with this size: number of copies since the nearest older sum of the same remainder.
        older = reach >= 0
        rows = -(-(left + 1) // s)
        padded = np.zeros(rows * s, bool)
        padded[: left + 1] = older
        grid = padded.reshape(rows, s)
        index = np.where(grid, np.arange(rows)[:, None], -1)
        last = np.maximum.accumulate(index, axis=0)
        copies = np.where(last >= 0, np.arange(rows)[:, None] - last, n + 1).ravel()[: left + 1]
        new = ~older & (copies <= n)
        reach[new], used[new] = i, copies[new]
    at = int(np.flatnonzero(reach >= 0)[-1])
    while at:
        i = int(reach[at])
        take[i] += used[at]
        at -= int(used[at]) * int(sizes[i])
    return take


def plan_mix(sized: DataFrame, source: str, weights: tuple[float, ...] = WEIGHTS, percent: float = TOTAL_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Targets per source (source, source_size, target), and (source, size, passes, extra): how often every document of
    that size is taken, and how many of them once more."""
    histogram = materialize(sized.groupBy(F.col(source).alias("source"), "size").agg(F.count(F.lit(1)).alias("n")))
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    spark = sized.sparkSession
    # Sources are a short list by nature (one row each); the order is by code point, null last.
    rows = sorted(sources.collect(), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in rows]
    targets = share_out(sizes, [weights[i % len(weights)] for i in range(len(rows))], percent / 100 * sum(sizes))
    kind = dict(sized.dtypes)[source]
    goal = spark.createDataFrame(
        [(r[0], s, t) for r, s, t in zip(rows, sizes, targets, strict=True)], f"source {kind}, source_size long, target double"
    )
    joined = histogram.join(F.broadcast(goal), histogram["source"].eqNullSafe(goal["source"])).select(
        histogram["source"], "size", "n", "source_size", "target"
    )

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        passes = min(int(target // total), MAX_REPEAT) if total else 0
        budget = int(target) - passes * total if passes < MAX_REPEAT else 0
        group = group.sort_values("size")
        extra = fit_budget(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), budget)
        return pd.DataFrame({"source": group["source"], "size": group["size"], "n": group["n"], "passes": passes, "extra": extra})

    fitted = joined.groupBy("source").applyInPandas(fit, f"source {kind}, size long, n long, passes long, extra long")
    return goal, materialize(fitted)


def mix(
    docs: DataFrame, source: str = "source", text: str = "text", doc_id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS,
    percent: float = TOTAL_PERCENT, seed: int = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target and repeats (how often the mix takes the document, 0 included).

    Columns of these names are replaced. Which documents are selected depends on seed, id and text only.
    """
    sized = docs.drop("size", "source_size", "target", "repeats").withColumn("size", word_count(text))
    goal, plan = plan_mix(sized, source, weights, percent)
    # A group of one source and size can hold a large share of all rows; it is numbered in buckets of the seeded hash.
    wanted = plan.select(
        F.col("source").alias("__source"), F.col("size").alias("__size"), "passes", "extra",
        F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(BUCKET_ROWS))).cast("int").alias("__buckets"),
    )
    wanted = F.broadcast(wanted) if fits_broadcast(plan, 8 << 20) else wanted
    hashed = sized.withColumn("__order", F.xxhash64(F.lit(seed), F.col(doc_id), F.coalesce(F.col(text), F.lit(""))))
    placed = hashed.join(wanted, F.col(source).eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")), "left").drop("__source", "__size")
    share = (F.shiftrightunsigned(F.col("__order"), 33).cast("double") / F.lit(float(1 << 31)) * F.col("__buckets")).cast("int")
    placed = placed.withColumn("__bucket", share)
    counts = materialize(
        placed.filter("__buckets > 1 AND extra > 0").groupBy(F.col(source).alias("__s"), F.col("size").alias("__z"), F.col("__bucket").alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    )
    before = F.sum("__n").over(Window.partitionBy("__s", "__z").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n")
    offsets = F.broadcast(offsets) if fits_broadcast(counts, 8 << 20) else offsets
    match = F.col(source).eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")) & (F.col("__bucket") == F.col("__b"))
    ranked = placed.join(offsets, match, "left").drop("__s", "__z", "__b")
    within = Window.partitionBy(source, "size", "__bucket").orderBy(F.shiftrightunsigned("__order", 33), "__order", doc_id)
    rank = F.coalesce("__before", F.lit(0)) + F.row_number().over(within)
    repeats = F.when(F.col("size") > 0, F.col("passes") + F.when(rank <= F.col("extra"), 1).otherwise(0)).otherwise(0)
    chosen = ranked.withColumn("repeats", repeats.cast("long")).drop("__order", "passes", "extra", "__buckets", "__bucket", "__before")
    names = goal.select(F.col("source").alias("__source"), "source_size", "target")
    return chosen.join(F.broadcast(names), F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")

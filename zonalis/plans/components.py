"""Connected components by joins."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize, size_in_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pointers in files up to this size are followed in one task; beyond it by joins.
TASK_BYTES = 1 << 20


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = list(batches)
    if not parts:
        return
    whole = pd.concat(parts)
    keys = [c for c in whole.columns if c not in ("id", "parent")]
    spots = list(zip(*(whole[k].tolist() for k in keys), whole["id"].tolist()))
    parent = dict(zip(spots, whole["parent"].tolist()))
    roots = []
    for spot in spots:
        path, at = [], spot
        while (onward := parent.get(at, at[-1])) != at[-1]:
            path.append(at)
            at = (*at[:-1], onward)
        for step in path:
            parent[step] = at[-1]
        roots.append(at[-1])
    yield whole.assign(parent=roots)


def shortcut(parents: DataFrame, keys: list[str], task_bytes: int | None = None) -> DataFrame:
    """Follow parent pointers to the root by doubling: (keys, id, parent) with parent = root on return. Stored."""
    parents = materialize(parents.select(*keys, "id", "parent"))
    if size_in_bytes(parents) <= (TASK_BYTES if task_bytes is None else task_bytes):
        return materialize(parents.coalesce(1).mapInPandas(_follow, parents.schema))
    while True:
        up = parents.select(*keys, F.col("id").alias("parent"), F.col("parent").alias("grand"))
        once = parents.join(up, [*keys, "parent"], "left").select(*keys, "id", F.coalesce("grand", "parent").alias("next"), "parent")
        again = up.withColumnsRenamed({"parent": "next", "grand": "great"})
        twice = once.join(again, [*keys, "next"], "left").select(*keys, "id", F.coalesce("great", "next").alias("next"), "parent")
        jumped = materialize(twice)
        moved = not jumped.filter(F.col("next") != F.col("parent")).isEmpty()
        parents = jumped.select(*keys, "id", F.col("next").alias("parent"))
        if not moved:
            return parents


def components(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, id, component): component is the smallest id reachable within the same keys.

    Each round hooks the larger root of every edge between two components to the smallest root it meets and then
    contracts all pointers, so long paths shrink geometrically.
    """
    labels = nodes.select(*keys, "id", F.col("id").alias("parent"))
    open_edges = edges.select(*keys, "a", "b")
    while True:
        a = labels.select(*keys, F.col("id").alias("a"), F.col("parent").alias("root_a"))
        b = labels.select(*keys, F.col("id").alias("b"), F.col("parent").alias("root_b"))
        rooted = open_edges.join(a, [*keys, "a"]).join(b, [*keys, "b"]).filter(F.col("root_a") != F.col("root_b"))
        hooks = materialize(
            rooted.select(*keys, F.greatest("root_a", "root_b").alias("id"), F.least("root_a", "root_b").alias("to"))
            .groupBy(*keys, "id").agg(F.min("to").alias("to"))
        )
        if hooks.isEmpty():
            return labels.withColumnRenamed("parent", "component")
        hooked = labels.join(hooks, [*keys, "id"], "left").select(*keys, "id", F.coalesce("to", "parent").alias("parent"))
        labels = shortcut(hooked, keys)

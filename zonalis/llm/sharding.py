"""Sharding to near-equal bytes by histogram sort (DataFrame operations only).

Rows are sorted by a 36-bit key, 24 bits of the text's hash and then 12 bits of a hash of the id, so equal texts lie
together and a text with very many copies can still be cut. Splitters between shards are found without sorting: exact
bytes below 4,096 candidate boundaries are counted across all partitions, and only the cells in which a splitter lies are
probed again, 4,096 times finer, until every splitter is within the tolerance of its ideal place or the key has no finer
digit. Whole cells of the text hash are preferred, so equal texts are parted only where a shard could not be near its
size otherwise. Then rows are exchanged once, by shard and key cell, and numbered.

Driver work is bounded by shards and probes: at most 4,096 counts per open splitter and round. A null text has no bytes
and is one byte in size. Null ids and repeated rows are kept; ties are ordered by id, then text hash. Extra columns are carried
along; columns of the input named like the results (size, text_crc32, shard, slot) are replaced by them, and names that begin
with two underscores are the operator's own. A very long text is hashed and measured, never cut; an empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize

SHARDS = 16
DIGIT = 12
LEVELS = 3
TOLERANCE = 0.002  # of an ideal shard's bytes
HEAVY = 4  # a cell with more than this many times the mean rows is cut by the next digit


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with size, text_crc32 and the sort key ``__key`` (0 to 2^36 - 1)."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "size": (F.octet_length(body) + 1).cast("long"),
        "text_crc32": F.crc32(body.cast("binary")),
        "__key": F.shiftleft(F.shiftrightunsigned(F.xxhash64(body), 40), DIGIT).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64(F.lit("id"), F.col(doc_id)), 64 - DIGIT)
        ),
    })


def _cell(level: int) -> Column:
    """The key without the digits below ``level`` (1 is the coarsest)."""
    return F.shiftright("__key", DIGIT * (LEVELS - level))


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> tuple[list[int], list[int]]:
    """Keys at which shards 1 .. n-1 begin, and the bytes below each; ``keys`` has __key and size."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    goals = [total * i / shards for i in range(1, shards)]
    slack = tolerance * total / shards
    best = {g: (0, 0) for g in goals}  # goal -> (bytes below, key)
    open_cells: dict[int | None, tuple[int, list[float]]] = {None: (0, goals)}  # cell -> (bytes below it, goals in it)
    for level in range(1, LEVELS + 1):
        shift = DIGIT * (LEVELS - level)
        part = keys if level == 1 else keys.filter(_cell(level - 1).isin([c for c in open_cells]))
        rows = part.groupBy(_cell(level).alias("cell")).agg(F.sum("size").alias("bytes")).collect()
        counted: dict[int | None, list[tuple[int, int]]] = {}
        for cell, count in sorted((int(r[0]), int(r[1])) for r in rows):
            counted.setdefault(None if level == 1 else cell >> DIGIT, []).append((cell, count))
        following: dict[int, tuple[int, list[float]]] = {}
        for parent, (below, inside) in open_cells.items():
            edges, running = [], below
            for cell, count in counted.get(parent, []):
                edges.append((running, cell))
                running += count
            edges.append((running, edges[-1][1] + 1 if edges else 0))
            for goal in inside:
                for position, cell in edges:
                    if abs(position - goal) < abs(best[goal][0] - goal):
                        best[goal] = (position, cell << shift)
                if abs(best[goal][0] - goal) > slack:
                    holder = max((e for e in edges[:-1] if e[0] <= goal), default=None)
                    if holder:
                        following.setdefault(holder[1], (holder[0], []))[1].append(goal)
        open_cells = following
        if not open_cells:
            break
    placed = [best[g] for g in goals]
    return [key for _, key in placed], [below for below, _ in placed]


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with size, text_crc32, shard (0-based) and slot (0-based, gapless in its shard, in key order)."""
    rows = keyed(docs, doc_id, text)
    keys = materialize(rows.select("__key", "size"))
    starts, _ = splitters(keys, shards, tolerance)
    number = sum((F.when(F.col("__key") >= s, 1).otherwise(0) for s in starts), F.lit(0)).cast("int")
    # Cells of about equal rows within shards: a heavy cell is cut by its next digit.
    mean = max(1, (keys.count() >> DIGIT) * HEAVY)
    heavy1 = keys.groupBy(_cell(1).alias("__h1")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > mean).select("__h1", F.lit(True).alias("__is1"))
    heavy2 = keys.join(F.broadcast(heavy1), _cell(1) == F.col("__h1"), "left_semi").groupBy(_cell(2).alias("__h2")).agg(F.count(F.lit(1)).alias("n"))
    heavy2 = heavy2.filter(F.col("n") > mean).select("__h2", F.lit(True).alias("__is2"))

    def celled(df: DataFrame) -> DataFrame:
        # At most 4096 / HEAVY cells of either level can be heavy, so both lists are bounded.
        out = df.join(F.broadcast(heavy1), _cell(1) == F.col("__h1"), "left").join(F.broadcast(heavy2), _cell(2) == F.col("__h2"), "left")
        cell = F.when(F.col("__is2"), F.col("__key")).when(F.col("__is1"), F.shiftleft(_cell(2), DIGIT)).otherwise(F.shiftleft(_cell(1), 2 * DIGIT))
        return out.withColumns({"shard": number, "__cell": cell}).drop("__h1", "__is1", "__h2", "__is2")

    counts = celled(keys).groupBy("shard", "__cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "__cell", F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("shard", "__cell").orderBy("__key", doc_id, "text_crc32", "size"))
    numbered = celled(rows).withColumn("__place", inside).join(offsets, ["shard", "__cell"])
    return numbered.withColumn("slot", (F.col("__before") + F.col("__place") - 1).cast("long")).drop("__key", "__cell", "__place", "__before")

"""Gradient-boosted regression trees over binned rows: the law of Spark's ``GBTRegressor`` (squared loss, variance gain, 32 bins, a
share of the rows per tree and of the features per node, tree 0 at weight 1 and the others at the learning rate).

A row takes a byte per feature and its label. Up to ``TASK_ROWS`` rows one task grows all trees, as the jobs of a level would
take longer than its work; beyond, rows stay in cached blocks and every level is a job that adds up the blocks' histograms.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
TASK_ROWS = 2_000_000
BLOCK_ROWS = 1_000_000
#: Trees after which the rows' predictions are worked out anew from all trees, which ends the chain of cached blocks.
CHAIN = 50


def cuts_of(df: DataFrame, width: int) -> list[np.ndarray]:
    """Per feature at most 31 values; a row's bin is the number of them below its value. All values but the last where a
    feature has at most 32, else values at equal shares of all rows."""
    out = []
    shares = [i / BINS for i in range(1, BINS)]
    cut = df.agg(*[F.percentile_approx(F.col("__x")[j], shares, 100_000).alias(f"c{j}") for j in range(width)]).first()
    for j in range(width):
        values = sorted(r.v for r in df.select(F.col("__x")[j].alias("v")).distinct().limit(BINS + 1).collect())
        out.append(np.array(values[:-1] if len(values) <= BINS else sorted(set(cut[j])), dtype=float))
    return out


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(features, rows) of bin numbers."""
    return np.stack([np.searchsorted(c, x[:, j]).astype(np.uint8) for j, c in enumerate(cuts)])


class Block:
    """Binned rows with their labels and what the trees so far predict."""

    def __init__(self, number: int, bins: np.ndarray, y: np.ndarray):
        self.number, self.bins, self.y, self.f = number, bins, y, np.zeros(len(y))
        self.used = self.target = None

    @classmethod
    def of(cls, held: dict) -> Block:
        """The block of a ``vars`` of one, which is what travels."""
        out = cls.__new__(cls)
        out.__dict__.update(held)
        return out

    def begin(self, tree: int, seed: int, rows: float) -> None:
        """What tree ``tree`` is fitted to, and the rows it sees."""
        self.used = np.ones(len(self.y), bool) if rows >= 1 else np.random.default_rng([seed, tree, self.number]).random(len(self.y)) < rows
        self.target = self.y if tree == 0 else 2.0 * (self.y - self.f)

    def histograms(self, node: np.ndarray, nodes: int) -> np.ndarray:
        """(count and sum, nodes, features, bins); rows at node ``nodes`` are left out. Features are counted two at a time."""
        width = len(self.bins)
        out = np.zeros((2, nodes, width, BINS))
        for j in range(0, width, 2):
            two = j + 1 < width
            cells = BINS * BINS if two else BINS
            code = node * cells
            code += self.bins[j].astype(np.intp) * BINS + self.bins[j + 1] if two else self.bins[j]
            for i, weights in enumerate((None, self.target)):
                found = np.bincount(code, weights, minlength=(nodes + 1) * cells)[: nodes * cells].reshape(nodes, -1, BINS)
                out[i, :, j] = found.sum(axis=2) if two else found[:, 0]
                if two:
                    out[i, :, j + 1] = found.sum(axis=1)
        return out


class Tree:
    """Nodes of one tree: the left rows of a split have bins up to ``bin``; ``left`` is -1 at a leaf, the right child follows the left."""

    def __init__(self):
        self.feature, self.bin, self.left = np.zeros(1, np.int32), np.zeros(1, np.int32), np.full(1, -1, np.int32)
        self.value, self.gains, self.last = np.zeros(1), {}, [0]

    @classmethod
    def of(cls, held: dict) -> Tree:
        out = cls.__new__(cls)
        out.__dict__.update(held)
        return out

    def step(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The children where rows at the nodes ``at`` go; a leaf is its own child."""
        left = np.where(self.left < 0, np.arange(len(self.left)), self.left)
        limit = np.where(self.left < 0, BINS, self.bin)
        start = self.feature.astype(np.intp) * bins.shape[1]
        return left[at] + (bins.ravel()[start[at] + np.arange(bins.shape[1])] > limit[at])

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node where every row ends."""
        at = np.zeros(bins.shape[1], np.intp)
        for _ in range(self.depth()):
            at = self.step(bins, at)
        return at

    def depth(self) -> int:
        level, steps = [0], 0
        while level := [c for n in level if self.left[n] >= 0 for c in (self.left[n], self.left[n] + 1)]:
            steps += 1
        return steps

    def slots(self) -> np.ndarray:
        """Number of every node among the newest ones, and how many these are for others."""
        out = np.full(len(self.left), len(self.last))
        out[self.last] = np.arange(len(self.last))
        return out

    def split(self, found: np.ndarray, asked: np.ndarray, first: bool) -> bool:
        """Splits the newest nodes where that lessens the variance; False when none is split."""
        count, total = found
        if first:
            self.value[0] = total[0, 0].sum() / max(count[0, 0].sum(), 1.0)
        n, s = count[:, 0].sum(axis=1), total[:, 0].sum(axis=1)
        left_n, left_s = count.cumsum(axis=2)[:, :, :-1], total.cumsum(axis=2)[:, :, :-1]
        right_n, right_s = n[:, None, None] - left_n, s[:, None, None] - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            whole = s * s / n
            gain = left_s**2 / left_n + right_s**2 / right_n - whole[:, None, None]
        gain[~((left_n >= 1) & (right_n >= 1) & asked[:, :, None])] = -np.inf
        best = gain.reshape(len(n), -1).argmax(axis=1)
        feature, cut = np.divmod(best, BINS - 1)
        row = np.arange(len(n))
        gained = gain[row, feature, cut]
        taken = np.flatnonzero(gained > 1e-12 * np.maximum(whole, 1e-300))
        new = []
        for i in taken:
            node, j, b = self.last[i], feature[i], cut[i]
            self.feature[node], self.bin[node], self.left[node] = j, b, len(self.left) + len(new)
            self.gains[int(j)] = self.gains.get(int(j), 0.0) + float(gained[i])
            new += [left_s[i, j, b] / left_n[i, j, b], right_s[i, j, b] / right_n[i, j, b]]
        self.last = list(range(len(self.left), len(self.left) + len(new)))
        self.value = np.append(self.value, new)
        self.feature, self.bin = (np.append(v, np.zeros(len(new), np.int32)) for v in (self.feature, self.bin))
        self.left = np.append(self.left, np.full(len(new), -1, np.int32))
        return bool(new)


def grow(histograms: Callable[[Tree], np.ndarray], tree: int, width: int, depth: int, columns: float, seed: int) -> Tree:
    """One tree; ``histograms`` adds up those of the newest nodes over all rows."""
    out, draw = Tree(), np.random.default_rng([seed, tree])
    some = max(1, min(width, math.ceil(columns * width)))
    for level in range(depth):
        nodes = len(out.last)
        asked = draw.random((nodes, width)).argsort(axis=1).argsort(axis=1) < some
        if not out.split(histograms(out), asked, level == 0):
            break
    return out


def weight_of(tree: int, rate: float) -> float:
    return 1.0 if tree == 0 else rate


def fit_block(block: Block, trees: int, rate: float, depth: int, rows: float, columns: float, seed: int) -> list[Tree]:
    """All trees of rows that are one block; where a row stands is kept from level to level."""
    out = []
    for number in range(trees):
        block.begin(number, seed, rows)
        at = np.zeros(len(block.y), np.intp)

        def found(tree: Tree) -> np.ndarray:
            nonlocal at
            if len(tree.left) > 1:
                at = tree.step(block.bins, at)
            node = tree.slots()[at]
            node[~block.used] = len(tree.last)
            return block.histograms(node, len(tree.last))

        tree = grow(found, number, len(block.bins), depth, columns, seed)
        block.f += weight_of(number, rate) * tree.value[tree.step(block.bins, at)]
        out.append(tree)
    return out


def _fit_blocks(blocks, trees: int, rate: float, depth: int, rows: float, columns: float, seed: int, width: int) -> list[Tree]:
    """The same with a job per level over an RDD of blocks."""
    base = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    state, out, chain = base, [], []

    def begun(number: int, known: list[Tree], first: int):
        def run(held: dict) -> dict:
            block = Block.of(held)
            for i, tree in enumerate(known, first):
                block.f += weight_of(i, rate) * tree.value[tree.place(block.bins)]
            block.begin(number, seed, rows)
            return vars(block)

        return run

    def level(tree: Tree):
        def run(held: dict) -> np.ndarray:
            block = Block.of(held)
            node = tree.slots()[tree.place(block.bins)]
            node[~block.used] = len(tree.last)
            return block.histograms(node, len(tree.last))

        return run

    try:
        for number in range(trees):
            fresh = number % CHAIN == 0
            state = (base if fresh else state).map(begun(number, out if fresh else out[-1:], 0 if fresh else number - 1))
            state.persist(StorageLevel.MEMORY_AND_DISK)
            out.append(grow(lambda tree: sum(state.map(level(tree)).collect()), number, width, depth, columns, seed))
            chain.append(state)
            while len(chain) > 2:
                chain.pop(0).unpersist()
    finally:
        for held in [*chain, base]:
            held.unpersist()
    return out


class Boosted:
    """Fitted trees with what the callers of Spark's model use of it."""

    def __init__(self, trees: list[Tree], rate: float, cuts: list[np.ndarray]):
        self.trees, self.rate, self.cuts = trees, rate, cuts

    @property
    def featureImportances(self):
        """Gains times rows per feature, in all 1."""
        gains = np.zeros(len(self.cuts))
        for tree in self.trees:
            for j, gain in tree.gains.items():
                gains[j] += gain
        return Vectors.dense(gains / gains.sum() if gains.sum() > 0 else gains)

    def transform(self, df: DataFrame) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(([vars(t) for t in self.trees], self.rate, self.cuts))

        def predicted(x: pd.Series) -> pd.Series:
            trees, rate, cuts = held.value
            out = np.zeros(len(x))
            if len(x):
                bins = binned(np.array(x.tolist(), dtype=float), cuts)
                for i, tree in enumerate(map(Tree.of, trees)):
                    out += weight_of(i, rate) * tree.value[tree.place(bins)]
            return pd.Series(out)

        return df.withColumn("prediction", F.pandas_udf(predicted, "double")(vector_to_array("__f")))


def fit(ready: DataFrame, n: int, trees: int, rate: float, depth: int, rows: float, columns: float, seed: int) -> Boosted:
    """Trees of the stored rows (__f vector, __y)."""
    opened = ready.select(vector_to_array("__f").alias("__x"), "__y")
    width = len(ready.first()["__f"])
    cuts = cuts_of(opened, width)
    law = dict(trees=trees, rate=rate, depth=depth, rows=rows, columns=columns, seed=seed)

    def packed(batches):
        for batch in batches:
            if len(batch):
                x = np.array(batch["__x"].tolist(), dtype=float)
                yield pd.DataFrame({"bins": [binned(x, cuts).tobytes()], "y": [batch["__y"].to_numpy(float).tobytes()]})

    def block_of(number: int, parts: list[tuple[bytes, bytes]]) -> Block:
        bins = [np.frombuffer(b, np.uint8).reshape(width, -1) for b, _ in parts]
        return Block(number, np.concatenate(bins, axis=1), np.concatenate([np.frombuffer(y, float) for _, y in parts]))

    cores = ready.sparkSession.sparkContext.defaultParallelism
    if n <= TASK_ROWS:
        blobs = opened.mapInPandas(packed, "bins binary, y binary").withColumn("at", F.monotonically_increasing_id()).repartition(1)

        def whole(batches):
            parts = pd.concat(list(batches)).sort_values("at")
            yield pd.DataFrame({"trees": [pickle.dumps([vars(t) for t in fit_block(block_of(0, list(zip(parts.bins, parts.y))), **law)])]})

        grown = [Tree.of(t) for t in pickle.loads(blobs.mapInPandas(whole, "trees binary").first()[0])]
    else:
        parts = max(cores, -(-n // BLOCK_ROWS))
        blobs = opened.repartition(parts).mapInPandas(packed, "bins binary, y binary")

        def blocks(number: int, found):
            held = [(bytes(r.bins), bytes(r.y)) for r in found]
            if held:
                yield vars(block_of(number, held))

        grown = _fit_blocks(blobs.rdd.mapPartitionsWithIndex(blocks), width=width, **law)
    return Boosted(grown, rate, cuts)

"""Quality by compression: which of two zstandard dictionaries, of good or of bad text, makes a text smaller.

Dictionaries are built from a bounded sample of labelled text; the sizes of a text under both, divided by its length, and
their difference are calibrated to a probability by logistic regression on a second bounded sample. Every text is scored
whole, piece by piece of ``PIECE`` bytes, so that the dictionaries matter as much at its end as at its start.

The samples are the documented bound: ``SAMPLE_ROWS`` rows of each label for the dictionaries and as many for the
calibration, by a seeded hash of the id. Dictionaries see one piece of at most ``PIECE`` characters from each text; the
calibration sees the sizes of whole texts, computed in tasks by the code that scores them. Labels, language,
source and id are no inputs of a score. Null and empty texts have a length of 0 and get the score of the calibration at
the neutral point. Without labels of both kinds every score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.textblock import flat, slices

PIECE = 4096
SAMPLE_ROWS = 1500
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
CUT = 0.3
SEED = 77


class Scorer:
    """Two dictionaries and the calibration; small and of fixed size."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = good, bad
        self.weights: np.ndarray | None = None
        self.constant = 0.5

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in (self.good, self.bad):
            trained = zstandard.ZstdCompressionDict(raw)
            trained.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def sizes(self, texts: list[memoryview | bytes]) -> np.ndarray:
        """(length, size under good, size under bad) per text."""
        good, bad = self.compressors()
        out = np.zeros((len(texts), 3))
        for row, text in enumerate(texts):
            for at in range(0, len(text), PIECE):
                piece = text[at : at + PIECE]
                out[row] += len(piece), len(good.compress(piece)), len(bad.compress(piece))
        return out

    @staticmethod
    def features(sizes: np.ndarray) -> np.ndarray:
        """1, the normalised difference, the normalised size, and their squares and product."""
        n = np.maximum(sizes[:, 0], 1)
        gap = np.where(sizes[:, 0] > 0, (sizes[:, 2] - sizes[:, 1]) / n, 0) * 10
        size = np.where(sizes[:, 0] > 0, sizes[:, 1] / n, 0.4) * 3
        length = np.log1p(n) / 5
        return np.stack([np.ones(len(n)), gap, size, gap * gap, size * size, gap * size, length, length * length, length * size, length * gap], 1)

    def score(self, sizes: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(sizes), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.features(sizes) @ self.weights, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Scorer:
    """A scorer from the labels (0 or 1) of some documents. The sample is drawn from the labels; texts are not shuffled."""
    order = F.xxhash64(F.lit(SEED), F.col(doc_id))
    narrow = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.length("text") > 0)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).alias("y"), order.alias("o"))
    shares = {int(r[0]): int(r[1]) for r in known.groupBy("y").count().collect()}
    drawn = [known.filter(F.col("y") == v).orderBy("o", "id").limit(2 * rows) for v in (0, 1)]
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most 4 * rows short rows
    body = F.col("text")
    place = F.lit(1) + F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("id")), F.greatest(F.length(body) - PIECE + 1, F.lit(1))).cast("int")
    # One text per drawn label, whatever number of documents share its id.
    one = F.min(F.struct(F.xxhash64(body).alias("x"), F.substr(body, place, F.lit(PIECE)).alias("t"))).alias("one")
    named = narrow.join(chosen, "id").groupBy("y", "o", "id").agg(one).select("y", "o", "id", "one.x", "one.t")
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    calibrating = []  # every second text of each label; the others make the dictionaries
    for y, _, name, x, t in sorted(named.collect()):
        if len(samples[int(y)]) % 2:
            calibrating.append((name, x))
        samples[int(y)].append(t.encode())
    scorer = Scorer(b"", b"")
    total = sum(shares.values())
    scorer.constant = shares.get(1, 0) / total if total else 0.5
    if min(len(samples[0]), len(samples[1])) < 20:
        return scorer
    scorer.bad, scorer.good = (zstandard.train_dictionary(DICTIONARY_BYTES, samples[v][::2]).as_bytes() for v in (0, 1))
    kind = dict(docs.dtypes)[doc_id]
    second = docs.sparkSession.createDataFrame(sorted(set(calibrating)), f"id {kind}, x long")
    whole = narrow.withColumn("x", F.xxhash64(body)).join(F.broadcast(second), ["id", "x"], "left_semi").dropDuplicates(["id", "x"])
    measured = score(whole.select("id", "text"), scorer, "id").join(F.broadcast(chosen), "id")
    sizes = measured.select("y", "n_bytes", "good_size", "bad_size").orderBy("y", "n_bytes", "good_size", "bad_size").toPandas().to_numpy(float)
    y = sizes[:, 0]
    weight = np.where(y == 1, shares[1] / max((y == 1).sum(), 1), shares[0] / max((y == 0).sum(), 1))
    scorer.weights = calibrate(scorer.features(sizes[:, 1:]), y, weight / weight.mean())
    return scorer


def score(docs: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, score, n_bytes, good_size, bad_size) for every row, with the columns of ``extra``."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in slices(batches):
            data, offsets = flat(piece.column(1))
            raw = memoryview(np.ascontiguousarray(data))
            sizes = np.zeros((piece.num_rows, 3))
            if model.good:
                sizes = model.sizes([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
            else:
                sizes[:, 0] = np.diff(offsets)
            counts = sizes.astype(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(model.score(sizes)), *(pa.array(counts[:, c]) for c in range(3))], names=["id", "score", "n_bytes", "good_size", "bad_size"])

    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(task, f"id {kind}, score double, n_bytes long, good_size long, bad_size long").withColumnRenamed("id", doc_id)
    return out.withColumns(extra) if extra else out

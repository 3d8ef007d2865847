"""Exact k-means on integer vectors, with centroids filtered by an n-simplex projection.

1. Vectors become integers, ``floor(SCALE * x)``. A few of them are pivots: the first of a hash-ordered sample of bounded
   size, then whichever is farthest from all chosen ones, as long as it adds a proper dimension to their simplex.
2. Each vector's exact squared distances to the pivots are turned once into the coordinates of an apex over the pivots'
   simplex (one coordinate per base dimension and an altitude) and stored beside the vector. Centroids get their apexes
   each round.
3. For two apexes the Euclidean distance is a lower bound of the true distance, and the distance with one altitude
   mirrored is an upper bound. A centroid whose lower bound is above the smallest upper bound is out; both bounds are
   widened by the rounding error that the simplex's condition allows. Only centroids that remain are compared, in exact
   integers; of equal distances the smaller number wins.
4. A round sends one row per task and cluster: a count and exact component sums. They are added up in Spark, and ``k`` rows
   reach the driver, which divides with exact floor. Rounds stop early when no centroid moves, as nothing would change.

Rows with a null vector, another number of components, a null or a non-finite component are left out, as are vectors with a
component beyond ``LARGEST`` in magnitude (no long holds their squared distances). A null id is kept and sorts last among
starts; equal ids are told apart by their vectors, and repeated rows are separate vectors. With fewer vectors than ``k``
there are fewer centroids; an empty table gives an empty result. Columns other than the two named are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.plans.materialize import materialize

WIDTH = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
START_KEY = "3:"
PIVOTS = 16
PIVOT_SAMPLE = 256
LARGEST = 1 << 17
CONDITION = 1e3
SLACK = 1e-9


@dataclass
class Simplex:
    """Pivots and the base of their simplex: ``lower`` is the Cholesky factor of the base edges' Gram matrix."""

    pivots: np.ndarray
    gram: np.ndarray
    inverse: np.ndarray

    @classmethod
    def of(cls, pivots: np.ndarray) -> Simplex:
        edges = pivots[1:] - pivots[0]
        gram = (edges @ edges.T).astype(float)
        return cls(pivots, np.diag(gram).copy(), np.linalg.inv(np.linalg.cholesky(gram)) if len(gram) else np.zeros((0, 0)))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the base and the altitude, from exact squared distances to the pivots."""
        squared = np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], axis=1)
        first = squared[:, 0].astype(float)
        base = ((squared[:, :1] - squared[:, 1:]).astype(float) + self.gram) / 2 @ self.inverse.T
        return np.column_stack([base, np.sqrt(np.maximum(first - (base * base).sum(1), 0.0))])


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots; a candidate that would make the base ill-conditioned is passed over."""
    chosen = sample[:1]
    nearest = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < count and nearest.max(initial=0) > 0:
        at = int(nearest.argmax())
        grown = np.vstack([chosen, sample[at]])
        edges = (grown[1:] - grown[0]).astype(float)
        scaled = edges / np.sqrt((edges * edges).sum(1, keepdims=True))
        if len(scaled) <= scaled.shape[1] and np.linalg.cond(scaled) <= CONDITION:
            chosen = grown
            nearest = np.minimum(nearest, ((sample - sample[at]) ** 2).sum(1))
        else:
            nearest[at] = 0
    return chosen


def candidates(apexes: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest, by the bounds of the projection."""
    own, theirs = (apexes * apexes).sum(1)[:, None], (of_centroids * of_centroids).sum(1)[None, :]
    total = own + theirs
    shared = apexes[:, :-1] @ of_centroids[:, :-1].T
    # Altitudes come from a difference and may be off by a share of the whole length.
    altitude = np.sqrt(apexes[:, -1:] ** 2 + SLACK * own) * np.sqrt(of_centroids[None, :, -1] ** 2 + SLACK * theirs)
    lower = total - 2 * (shared + altitude) - SLACK * total
    upper = total - 2 * (shared - altitude) + SLACK * total
    return lower <= upper.min(axis=1, keepdims=True)


def nearest_centroids(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex, measure: bool) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) per vector; without ``measure`` a vector with one candidate is not measured."""
    possible = candidates(apexes, simplex.apexes(centroids))
    open_ = possible if measure else possible & (possible.sum(1, keepdims=True) > 1)
    distance = np.where(possible, np.int64(0), np.iinfo(np.int64).max)
    for c, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, c])
        gap = vectors[rows] - centroid
        distance[rows, c] = (gap * gap).sum(1)
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(vectors)), cluster]


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(len(column), width)


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column, width: int) -> Column:
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST)

    return F.coalesce((F.size(vector) == width) & ~F.exists(vector, bad), F.lit(False))


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH,
    scale: int = SCALE, start_key: str = START_KEY, pivots: int = PIVOTS,
) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) stored, final centroids)."""
    kept = vectors.filter(usable(F.col(embedding), width)).select(F.col(vec_id).cast("long").alias("id"), integers(F.col(embedding), scale).alias("v"))
    spark = vectors.sparkSession
    digest = F.sha2(F.concat(F.lit(start_key), F.col("id").cast("string")), 256)
    starts = [r.v for r in kept.orderBy(digest.asc_nulls_last(), "v").select("v").limit(k).collect()]
    if not starts:
        return spark.createDataFrame([], "id long, cluster int, distance long"), []
    sample = kept.orderBy(F.xxhash64("v"), "v").select("v").limit(PIVOT_SAMPLE).collect()
    simplex = Simplex.of(choose_pivots(np.array([r.v for r in sample], np.int64), pivots))
    size = len(simplex.pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(_matrix(batch.column(1), width, np.int64))
            offsets = np.arange(0, apexes.size + 1, size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, apexes.ravel())], names=["id", "v", "apex"])

    stored = materialize(kept.mapInArrow(project, "id long, v array<long>, apex array<double>"))
    centroids = [list(v) for v in starts]

    def blocks(batches: Iterator[pa.RecordBatch], points: np.ndarray, measure: bool):
        for batch in batches:
            v, apexes = _matrix(batch.column("v"), width, np.int64), _matrix(batch.column("apex"), size, float)
            yield batch, v, *nearest_centroids(v, apexes, points, simplex, measure)

    for _ in range(rounds):
        points = np.array(centroids, np.int64)

        def sums(batches: Iterator[pa.RecordBatch], points: np.ndarray = points) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(points.shape, np.int64), np.zeros(len(points), np.int64)
            for _, v, cluster, _ in blocks(batches, points, False):
                for c in np.unique(cluster):
                    mine = cluster == c
                    total[c] += v[mine].sum(0)
                    count[c] += mine.sum()
            met = np.flatnonzero(count)
            offsets = np.arange(0, len(met) * width + 1, width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met.astype(np.int32)), pa.array(count[met]), pa.ListArray.from_arrays(offsets, total[met].ravel())], names=["cluster", "n", "sums"]
            )

        added = stored.select("v", "apex").mapInArrow(sums, "cluster int, n long, sums array<long>").groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(width)]).alias("sums")
        )
        moved = list(centroids)
        for row in added.collect():  # at most k rows
            moved[row.cluster] = [int(s) // row.n for s in row.sums]
        if moved == centroids:
            break
        centroids = moved

    final = np.array(centroids, np.int64)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, cluster, distance in blocks(batches, final, True):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    return materialize(stored.mapInArrow(label, "id long, cluster int, distance long")), centroids


def with_inertia(labelled: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds cluster_inertia, inertia (null where no long holds the sum) and the digest of each cluster's centroid."""
    added = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # one row per cluster
    own = {row.cluster: int(row.own) for row in added}
    fits = [own.get(c, 0) if own.get(c, 0) < 1 << 63 else None for c in range(len(centroids))]
    whole = sum(own.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list, kind: str) -> Column:
        return F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>")[F.col("cluster")]

    return labelled.withColumns({
        "cluster_inertia": of_cluster(fits, "long"), "inertia": F.lit(whole if whole < 1 << 63 else None).cast("long"), "centroid_sha256": of_cluster(digests, "string"),
    })


def check_sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same clustering in plain SQL, one pair of steps per round."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT n - 1 AS c, v AS w FROM (SELECT v, row_number() OVER (ORDER BY sha256('{START_KEY}' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) AS n
  FROM kept) WHERE n <= {k})""",
    ]
    for at in range(rounds + 1):
        parts.append(f"""a{at} AS MATERIALIZED (SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT r, c, CAST(list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept, c{at}) GROUP BY r)""")
        if at < rounds:
            parts.append(f"""s{at} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM (
  SELECT a.c, unnest(k.v) AS x, generate_subscripts(k.v, 1) AS i FROM a{at} a JOIN kept k ON k.r = a.r) GROUP BY c, i)""")
            parts.append(f"""c{at + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.w, o.w) AS w FROM c{at} o LEFT JOIN (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM s{at} GROUP BY c) m ON m.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(f.w, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k ON k.r = a.r JOIN c{rounds} f ON f.c = a.c"""


CHECK_SQL = check_sql()

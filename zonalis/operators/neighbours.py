"""Nearest-neighbour operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalis.plans import kernels
from zonalis.plans.blocks import BLOCK_ROWS, SOURCE_ROWS, against_slabs, block_apply, is_broadcast, k_best, nearest
from zonalis.plans.cells import ROUNDING
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join


DONOR_PAIRS = 1 << 29  # targets times donors per task; a search by cells compares few of them


def vector_of(columns: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def points(df: DataFrame, row_id: str, features: Column) -> DataFrame:
    return df.select(F.col(row_id).cast("long").alias("id"), features.alias("features"))


def knn_join(query: DataFrame, reference: DataFrame, k: int, skip_self: bool = False, **limits: int) -> DataFrame:
    """Exact Euclidean k nearest rows of ``reference`` (id, features) per row of ``query`` (id, features)."""
    return nearest(query, reference, k, "euclid", skip_self, **limits)


def core_distance(df: DataFrame, min_samples: int, **limits: int) -> DataFrame:
    """Distance to the ``min_samples``-th nearest row, the row itself counted as the first."""
    found = nearest(df, df, min_samples, "euclid", **limits)
    return found.groupBy("id").agg(F.max("distance").alias("core"))


def mutual_reachability(df: DataFrame, min_samples: int, k: int, **limits: int) -> DataFrame:
    """Edges to the ``k`` nearest other rows, weighted by max(core_a, core_b, distance)."""
    core = materialize(core_distance(df, min_samples, **limits))
    edges = nearest(df, df, k, "euclid", skip_self=True, **limits)
    edges = lookup_join(edges.join(core, "id"), core.withColumnsRenamed({"id": "other", "core": "other_core"}), ["other"], False, stored=True)
    return edges.select("id", "other", F.greatest("core", "other_core", "distance").alias("weight"))


def assign_to_clusters(train: DataFrame, test: DataFrame, k: int = 1, **limits: int) -> DataFrame:
    """Majority label of the ``k`` nearest non-noise training rows; smallest label on a tie; -1 without any.

    ``train`` has (id, features, label), ``test`` (id, features).
    """
    usable = materialize(train.filter(F.col("label") != -1))
    if usable.isEmpty():
        return test.select("id", F.lit(-1).alias("label"))
    found = nearest(test, usable, k, "euclid", **limits)
    # one training row may be the neighbour of very many test rows
    found = lookup_join(found, usable.select(F.col("id").alias("other"), "label"), ["other"], False, stored=True)
    votes = found.groupBy("id", "label").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"].alias("label"))


def knn_impute(
    train: DataFrame, df: DataFrame, row_id: str, columns: list[str], k: int = 5,
    source_rows: int = SOURCE_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Null cells of ``df`` take the mean of the ``k`` nearest training rows that have the value.

    Distance is Euclidean over common coordinates, scaled up to all of them; a column no donor has stays null. Equal
    training rows are one donor with the first ``k`` of their ids, and equal gappy rows are solved once.
    """
    def cells(frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(row_id).cast("long").alias("__id"))

    features = F.array(*[F.coalesce(F.col(c), F.lit(float("nan"))) for c in columns]).alias("features")
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in columns]) == 1
    place = F.row_number().over(Window.partitionBy("features").orderBy("id"))
    name = F.coalesce("__id", F.lit((1 << 63) - 1)).alias("id")
    first = cells(train).select(name, features).withColumn("__n", place).filter(F.col("__n") <= k)
    donors = materialize(first.groupBy("features").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("copies")))
    gappy = cells(df).filter(any_null)
    schema = "id bigint, position int, other bigint, value double, distance double"

    def partial_of(targets: DataFrame) -> DataFrame:
        kernel = kernels.donors_kernel(k)
        if is_broadcast(donors, source_rows) or donors.isEmpty():
            return block_apply(targets, donors, kernel, schema, None, source_rows, block_rows, DONOR_PAIRS)
        # a distance is no less than the gap in any common column: the one that most donors have leads the search
        has = [~F.isnan(F.col("features")[i]) for i in range(len(columns))]
        known = donors.agg(*[F.count_if(h & (F.abs(F.col("features")[i]) < float("inf"))).alias(f"n{i}") for i, h in enumerate(has)]).first()
        lead = max(range(len(columns)), key=lambda i: (known[i], -i))
        led = has[lead] & (F.abs(F.col("features")[lead]) < float("inf"))
        led = F.coalesce(led, F.lit(False))
        with_lead, without = materialize(donors.filter(led)), donors.filter(~led)
        asked = materialize(targets.filter(led))
        out = against_slabs(asked, with_lead, kernel, schema, lead, _settled(with_lead, len(columns), k), max(4 * k, block_rows // 5), block_rows)
        for some, others in ((asked, without), (targets.filter(~led), donors)):
            if not (others.isEmpty() or some.isEmpty()):
                out = out.unionByName(block_apply(some, materialize(others), kernel, schema, None, source_rows, block_rows, DONOR_PAIRS))
        return out

    def filled(targets: DataFrame) -> DataFrame:
        partial = partial_of(targets)
        means = k_best(partial, ["id", "position"], k).groupBy("id", "position").agg(F.avg("value").alias("value"))
        return means.groupBy("id").agg(*[F.max(F.when(F.col("position") == i, F.col("value"))).alias(f"__{c}") for i, c in enumerate(columns)])

    lacking = materialize(gappy.select(*columns).distinct().withColumn("__id", F.monotonically_increasing_id()))
    wide = filled(lacking.select(F.col("__id").alias("id"), features))
    keys = [f"__key_{c}" for c in columns]
    solved = lacking.join(wide, F.col("__id") == F.col("id")).select(*[F.col(c).alias(n) for c, n in zip(columns, keys)], *[f"__{c}" for c in columns])
    asked = df.withColumns({n: F.col(c).cast("double") for c, n in zip(columns, keys)})
    joined = lookup_join(asked, solved, keys, null_safe=True, row_id=row_id).drop(*keys)
    values = {c: F.when(F.col(row_id).isNotNull(), F.col(f"__{c}")) for c in columns}
    # gappy rows that share an id are filled alike, from the neighbours of all of them
    shared = materialize(gappy.groupBy("__id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1 AND __id IS NOT NULL").select("__id"))
    if not shared.isEmpty():
        together = materialize(lookup_join(gappy, shared.withColumn("__both", F.lit(True)), ["__id"], null_safe=False).filter("__both"))
        by_id = filled(together.select(F.col("__id").alias("id"), features)).select("id", F.struct(*[f"__{c}" for c in columns]).alias("__shared"))
        by_id = shared.join(by_id, F.col("__id") == F.col("id"), "left").select(F.col("__id").alias("__row"), F.lit(True).alias("__both"), "__shared")
        joined = lookup_join(joined.withColumn("__row", F.col(row_id).cast("long")), by_id, ["__row"], null_safe=False).drop("__row")
        values = {c: F.when(F.col("__both"), F.col(f"__shared.__{c}")).otherwise(v) for c, v in values.items()}
    return joined.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()}).drop("__both", "__shared", *[f"__{c}" for c in columns])


def _settled(donors: DataFrame, width: int, k: int):
    """For ``against_slabs``: targets whose every missing column has its ``k`` nearest of ``donors``, or all there are."""
    row = donors.agg(*[F.sum(F.when(~F.isnan(F.col("features")[i]), F.size("copies"))).alias(f"n{i}") for i in range(width)]).first()
    total = [n or 0 for n in row]

    def done(targets: DataFrame, found: DataFrame, reach: float) -> DataFrame:
        near = F.col("distance") < reach - 2 * ROUNDING
        counts = found.groupBy("id").agg(*[
            F.struct(F.count_if(F.col("position") == i).alias("all"), F.count_if((F.col("position") == i) & near).alias("near")).alias(f"c{i}") for i in range(width)
        ])
        asked = targets.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), *[F.max(F.isnan(F.col("features")[i])).alias(f"m{i}") for i in range(width)])
        # rows that share an id look for the nearest of all their pairs
        full = [(F.col(f"c{i}.near") >= k) | (F.col("rows") == 1) & (F.col(f"c{i}.all") >= total[i]) for i in range(width)]
        return asked.join(counts, "id").filter(reduce(lambda a, b: a & b, [~F.col(f"m{i}") | f for i, f in enumerate(full)]))

    return done


def knn_haversine_classify(
    known: DataFrame, unknown: DataFrame, row_id: str, zone: str = "square_id", k: int = 7, accept: float = 0.6, **limits: int
) -> DataFrame:
    """Zone by inverse-distance vote of the ``k`` nearest known rows on the globe; null below the accepted share.

    Copies of a known point are folded into one source with a count, and equal unknown points are solved once, so a
    place that holds a third of all rows is one point. A neighbour at distance zero decides alone.
    """
    ll = ["latitude", "longitude"]
    usable = known.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col(zone).isNotNull())
    folded = usable.groupBy(*ll, zone).agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("copies"))
    # of the zones at one place, all equally far, only the first can be among the nearest
    ahead = F.sum("copies").over(Window.partitionBy(*ll).orderBy(zone).rowsBetween(Window.unboundedPreceding, -1))
    first = folded.withColumn("__ahead", ahead).filter(F.coalesce("__ahead", F.lit(0)) < k).drop("__ahead")
    sources = materialize(_with_point_id(first, [zone, *ll]))
    asked = materialize(_with_point_id(unknown.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(*ll).distinct(), ll))
    radians = F.array(F.radians("latitude"), F.radians("longitude"))
    found = nearest(asked.select("id", radians.alias("features")), sources.select("id", radians.alias("features")), k, "haversine", **limits)
    found = lookup_join(found, sources.select(F.col("id").alias("other"), F.col(zone).alias("zone"), "copies"), ["other"], False, stored=True)
    order = Window.partitionBy("id").orderBy("distance", "zone", "other").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(order), F.lit(0))
    found = found.withColumn("used", F.least(F.col("copies"), F.lit(k) - before)).filter(F.col("used") > 0)
    zero = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("id")) == 1
    found = found.withColumn("vote", F.when(zero, F.when(F.col("distance") == 0, F.col("used")).otherwise(0)).otherwise(F.try_divide(F.col("used"), F.col("distance"))))
    votes = found.groupBy("id", "zone").agg(F.sum("vote").alias("vote"))
    best = votes.groupBy("id").agg(F.min(F.struct((-F.col("vote")).alias("v"), "zone")).alias("b"), F.sum("vote").alias("total"))
    share = -F.col("b.v") / F.col("total")
    decided = asked.join(best, "id").select(*ll, F.when(share >= accept, F.col("b.zone")).alias("knn_zone"), share.alias("share"))
    return lookup_join(unknown.select(row_id, *ll), decided, ll, False, row_id).select(row_id, "knn_zone", "share")


def _with_point_id(df: DataFrame, columns: list[str]) -> DataFrame:
    """A number per distinct point, increasing in ``columns``; callers store the result, which fixes the numbers."""
    return df.orderBy(*columns).withColumn("id", F.monotonically_increasing_id())

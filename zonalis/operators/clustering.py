"""Clustering of points (id, features array<double>), usually one row per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.operators.cluster_metrics import score_settings
from zonalis.plans import kernels
from zonalis.plans.blocks import BLOCK_ROWS, MOST_TASKS, PLACE_ROWS, SOURCE_ROWS, block_apply, by_place, dealt_rows, is_broadcast, nearest
from zonalis.plans.components import components, shortcut
from zonalis.plans.lloyd import Fit, lloyd
from zonalis.plans.materialize import materialize
from zonalis.plans.merge_tree import BLOCK_EDGES, density_clusters, merges
from zonalis.plans.numbering import global_index
from zonalis.plans.skew import lookup_join

# Settings tried by the sweeps.
DBSCAN_GRID = [(e, m) for e in (0.3, 0.5, 0.7, 1.0, 1.5) for m in (3, 5, 7, 10)]
DBSCAN_CUT_GRID = [(e, m) for e in (1.0, 1.5, 2.0, 3.0, float("inf")) for m in (3, 5, 8, 10, 15)]
MICROCLUSTER_GRID = [(t, k) for t in (0.2, 0.3, 0.5, 0.7) for k in range(2, 9)]
HDBSCAN_GRID = [(c, s) for c in (5, 8, 10, 12, 15) for s in (None, 3, 5, 8)]


def kmeans_fits(df: DataFrame, ks: list[int], n_init: int = 10, seed: int = 42, weight: str | None = None, max_iter: int = 300) -> list[Fit]:
    """For every k the best of ``n_init`` starts by cost; all starts of all k share every pass."""
    share = F.col(weight).cast("double") if weight else F.lit(1.0)
    name = F.col("id") if "id" in df.columns else F.xxhash64("features")
    return lloyd(materialize(df.select(name.alias("id"), "features", share.alias("weight"))), list(ks), n_init, seed, max_iter)


def kmeans_assign(fit: Fit, df: DataFrame) -> DataFrame:
    return df.withColumn("label", fit.label(F.col("features")))


def kmeans_fit_assign(train: DataFrame, test: DataFrame | None, k: int, n_init: int = 10, seed: int = 42):
    """(labelled train, labelled test, inertia)."""
    fit = kmeans_fits(train, [k], n_init, seed)[0]
    return kmeans_assign(fit, train), None if test is None else kmeans_assign(fit, test), fit.cost


def kmeans_sweep(df: DataFrame, ks: list[int], n_init: int = 1, seed: int = 42, **limits: int) -> DataFrame:
    """k, inertia and quality per k, best silhouette first."""
    points = materialize(df.select("id", "features"))
    fits = kmeans_fits(points, ks, n_init, seed)
    labels = points.select("id", F.posexplode(F.array(*[f.label(F.col("features")) for f in fits])).alias("setting", "label"))
    scores = score_settings(points, materialize(labels), len(ks), **limits)
    named = scores.withColumns({"k": F.array(*map(F.lit, ks))[F.col("setting")], "inertia": F.array(*[F.lit(f.cost) for f in fits])[F.col("setting")]})
    return named.select("k", "inertia", "silhouette", "dbi", "calinski_harabasz").orderBy(F.col("silhouette").desc_nulls_last(), "k")


def default_eps(min_cluster_size: int) -> float:
    return max(0.3, 0.1 * min_cluster_size)


def dbscan_sweep(
    df: DataFrame, settings: list[tuple[float, int]], source_rows: int = SOURCE_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, setting, label) for all (eps, min_samples) at once.

    Equal points are folded into one with a weight first. A task returns a degree per point and setting, then what joins
    core points: pairs of components in few coordinates, the smallest label within eps in many. A border point takes the
    cluster with the lowest core point; clusters are numbered by their lowest core point.
    """
    every = list(enumerate(settings))
    endless = [(i, m) for i, (e, m) in every if float(e) == float("inf")]
    if endless:  # everything is within reach of everything
        rows = df.count()
        whole = F.array(*[F.struct(F.lit(i).alias("setting"), F.lit(0 if rows >= m else -1).alias("label")) for i, m in endless])
        found = df.select("id", F.explode(whole).alias("f")).select("id", "f.setting", "f.label")
        rest = [i for i, (e, _) in every if float(e) < float("inf")]
        if not rest:
            return found
        some = dbscan_sweep(df, [settings[i] for i in rest], source_rows, block_rows)
        return found.unionByName(some.select("id", F.array(*map(F.lit, rest))[F.col("setting")].alias("setting"), F.col("label").cast("int").alias("label")))
    folded = df.groupBy("features").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    points = materialize(global_index(folded, ["first_id"], "id").select("id", "features", "weight"))
    radii = [float(e) for e, _ in settings]
    reach = max(radii)
    count = len(settings)
    narrow = points.select(F.size("features").alias("n")).first()
    narrow = narrow is not None and narrow.n < kernels.WIDE
    kernel = kernels.degree_kernel(radii, [m for _, m in settings])
    if not narrow:
        points = dealt_rows(points)
    degrees = block_apply(points, points, kernel, "id bigint, degree array<double>", reach, source_rows, block_rows, by_cells=True, dealt=not narrow)
    degrees = degrees.groupBy("id").agg(F.array(*[F.sum(F.col("degree")[i]) for i in range(count)]).alias("degree"))
    nan = F.lit(float("nan"))
    start = F.array(*[F.when(F.col("degree")[i] >= m, F.col("id").cast("double")).otherwise(nan) for i, (_, m) in enumerate(settings)])
    if narrow:
        state = materialize(points.join(degrees, "id").select("id", "features", start.alias("labels")))
        state, found = _joined_labels(state, radii, source_rows, block_rows)
    else:
        labels, found = _travelling_labels(points, materialize(degrees.select("id", start.alias("labels"))), radii, source_rows, block_rows)
        state = lookup_join(points.select("id", "features"), labels, ["id"], null_safe=False, row_id="id", stored=True)
    final = F.zip_with("labels", "least", lambda own, near: F.when(F.isnan(own), near).otherwise(own))
    rooted = state.join(found, "id", "left").withColumn("least", F.coalesce("least", F.array_repeat(nan, count))).select("features", F.posexplode(final).alias("setting", "root"))
    names = rooted.filter(F.col("root").isNotNull() & ~F.isnan("root")).select("setting", "root").distinct()
    placed = materialize(global_index(names, ["setting", "root"], "at"))
    first = F.broadcast(placed.groupBy("setting").agg(F.min("at").alias("first")))  # a row per setting
    names = placed.join(first, "setting").select("setting", "root", (F.col("at") - F.col("first")).cast("int").alias("label"))
    labelled = lookup_join(rooted, names, ["setting", "root"], null_safe=False, row_id="features").select("features", "setting", F.coalesce("label", F.lit(-1)).alias("label"))
    packed = labelled.groupBy("features").agg(F.collect_list(F.struct("setting", "label")).alias("found"))
    every = lookup_join(df.select("id", "features"), packed, ["features"], null_safe=False, row_id="id")
    return every.select("id", F.explode("found").alias("f")).select("id", "f.setting", "f.label")


def _travelling_labels(points: DataFrame, labels: DataFrame, radii: list[float], source_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Labels (id, labels) of core points once they have travelled as far as they can, and (id, least) around every point:
    round by round, for wide points. Coordinates stay where they are stored; a round writes labels only."""
    reach, count, nan = max(radii), len(radii), F.lit(float("nan"))
    kernel = kernels.least_label_kernel(radii)
    cores = materialize(labels.filter(F.exists("labels", lambda x: ~F.isnan(x))).select("id"))
    cores = materialize(points.select("id", "features").join(cores, "id"))
    while True:
        state = lookup_join(cores, labels, ["id"], null_safe=False, row_id="id", stored=True)
        if is_broadcast(cores, source_rows):
            state = materialize(state)
        found = block_apply(points, state, kernel, "id bigint, least array<double>", reach, source_rows, block_rows, dealt=True)
        found = materialize(found.groupBy("id").agg(F.array(*[F.min(F.col("least")[i]) for i in range(count)]).alias("least")))
        merged = labels.join(found, "id")
        lower = F.zip_with("labels", "least", lambda own, near: F.when(F.isnan(own), own).otherwise(F.least(own, near)))
        long = merged.select("id", F.posexplode(lower).alias("s", "parent")).filter(~F.isnan("parent"))
        # one pointer step per round: a label takes over the label of the point it names
        named = long.select("s", F.col("id").cast("double").alias("parent"), F.col("parent").alias("onward"))
        stepped = long.join(named, ["s", "parent"], "left").select("s", "id", F.coalesce("onward", "parent").alias("parent"))
        wide = stepped.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("s", "parent"))).alias("m"))
        new = F.array(*[F.coalesce(F.try_element_at("m", F.lit(i)), nan) for i in range(count)])
        joined = materialize(labels.join(wide, "id", "left").select("id", new.alias("new"), "labels"))
        changed = not joined.filter(F.exists(F.zip_with("new", "labels", lambda a, b: ~a.eqNullSafe(b)), lambda c: c)).isEmpty()
        labels = materialize(joined.select("id", F.col("new").alias("labels")))
        if not changed:
            return labels, found


def _joined_labels(state: DataFrame, radii: list[float], source_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The same for points in few coordinates. Core points of a task are united first; then tasks give out pairs of what is
    still apart, and these are joined as a graph of components. Only points that are not core look for the least label."""
    reach, count, limits = max(radii), len(radii), (source_rows, block_rows)
    tasks = max(1, min(state.count() // PLACE_ROWS, MOST_TASKS))
    near = by_place(state, tasks).mapInPandas(kernels.local_components(radii), "id bigint, labels array<double>")
    # pandas hands NaN inside lists back as null
    near = near.withColumn("labels", F.transform("labels", lambda x: F.coalesce(x, F.lit(float("nan")))))
    state = materialize(state.drop("labels").join(near, "id"))
    links = materialize(block_apply(state, state, kernels.links_kernel(radii), "s int, a bigint, b bigint", reach, *limits, by_cells=True))
    if not links.isEmpty():
        ends = links.select("s", F.col("a").alias("id")).union(links.select("s", F.col("b").alias("id"))).distinct()
        joined = components(materialize(ends), links, ["s"]).select("s", F.col("id").cast("double").alias("own"), F.col("component").cast("double").alias("joined"))
        long = state.select("id", F.posexplode("labels").alias("s", "own"))
        named = lookup_join(long, joined, ["s", "own"], null_safe=False, row_id="id").groupBy("id").agg(
            F.map_from_entries(F.collect_list(F.struct("s", F.coalesce("joined", "own").alias("label")))).alias("m")
        )
        labels = F.array(*[F.col("m")[i] for i in range(count)])
        state = materialize(state.drop("labels").join(named.select("id", labels.alias("labels")), "id"))
    border = state.filter(F.exists("labels", lambda x: F.isnan(x)))
    cores = materialize(state.filter(F.exists("labels", lambda x: ~F.isnan(x))))
    schema = "id bigint, least array<double>"
    found = block_apply(border, cores, kernels.least_label_kernel(radii, 1), schema, reach, *limits, by_cells=True)
    found = materialize(found.groupBy("id").agg(F.array(*[F.min(F.col("least")[i]) for i in range(count)]).alias("least")))
    return state, found


def dbscan(df: DataFrame, eps: float, min_samples: int, **limits: int) -> DataFrame:
    return dbscan_sweep(df, [(eps, min_samples)], **limits).select("id", "label")


def dbscan_cut(df: DataFrame, min_samples: int, max_eps: float, **limits: int) -> DataFrame:
    """Reachability cut at ``max_eps``: the density clusters at that radius."""
    return dbscan(df, max_eps, min_samples, **limits)


def _microcells(df: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(rows with their grid cell of side ``threshold``, one row of moments per cell)."""
    width = df.select(F.size("features")).first()[0]
    celled = df.withColumn("cell", F.transform("features", lambda x: F.floor(x / threshold).cast("long")))
    cells = celled.groupBy("cell").agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.array(*[F.avg(F.col("features")[i]) for i in range(width)]).alias("features")
    )
    return celled, materialize(cells)


def cf_microcluster(df: DataFrame, threshold: float, k: int, n_init: int = 10, seed: int = 42) -> DataFrame:
    """Moments per grid cell of side ``threshold`` in one aggregation, weighted k-means over the cell means, labels back."""
    celled, cells = _microcells(df, threshold)
    labels = kmeans_assign(kmeans_fits(cells, [k], n_init, seed, weight="weight")[0], cells).select("cell", "label")
    return lookup_join(celled, labels, ["cell"], null_safe=False, row_id="id").drop("cell")


def microcluster_labels(df: DataFrame, settings: list[tuple[float, int]], n_init: int = 1, seed: int = 42) -> DataFrame:
    """(id, setting, label) for all (threshold, k); the k-means passes over the cells of all thresholds are shared."""
    thresholds = sorted({t for t, _ in settings})
    parts = [_microcells(df, t) for t in thresholds]
    cells = parts[0][1].withColumn("part", F.lit(0))
    for i, (_, more) in enumerate(parts[1:], 1):
        cells = cells.unionByName(more.withColumn("part", F.lit(i)))
    cells = materialize(cells.withColumn("id", F.xxhash64("cell")))
    of = [thresholds.index(t) for t, _ in settings]
    fits = lloyd(cells, [k for _, k in settings], n_init, seed, parts=of)
    labels = None
    for part, (celled, _) in enumerate(parts):
        mine = [F.struct(F.lit(i).alias("setting"), f.label(F.col("features")).alias("label")) for i, f in enumerate(fits) if of[i] == part]
        named = cells.filter(F.col("part") == part).select("cell", F.array(*mine).alias("found"))
        joined = lookup_join(celled, named, ["cell"], null_safe=False, row_id="id", stored=True).select("id", F.explode("found").alias("f")).select("id", "f.setting", "f.label")
        labels = joined if labels is None else labels.unionByName(joined)
    return labels


def cf_microcluster_best(df: DataFrame, threshold: float, ks: list[int] = (2, 3, 4, 5, 6, 7), n_init: int = 1, **limits: int) -> tuple[DataFrame, int]:
    """The number of clusters with the best silhouette, the first one when none can be scored."""
    points = materialize(df.select("id", "features"))
    labels = materialize(microcluster_labels(points, [(threshold, k) for k in ks], n_init))
    scores = score_settings(points, labels, len(ks), **limits).filter("silhouette IS NOT NULL").orderBy(F.col("silhouette").desc(), "setting").head()
    best = scores.setting if scores else 0
    return df.join(labels.filter(F.col("setting") == best).select("id", "label"), "id"), ks[best]


def spanning_trees(df: DataFrame, samples: list[int], source_rows: int = SOURCE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Minimum spanning trees (tree, low, high, weight) under mutual reachability, one per entry of ``samples``. Stored.

    Every round each component takes its lightest outgoing edge (equal weights ordered by the pair of ids, which rules
    out cycles), and components are merged along those edges: at least halving their number. Distances are computed once
    for all trees, and only between cells that can hold a lightest edge.
    """
    stored = materialize(df.select("id", "features"))
    found = nearest(stored, stored, max(samples), "euclid", source_rows=source_rows, block_rows=block_rows)
    cores = F.array(*[F.max(F.when(F.col("neighbour") <= s, F.col("distance"))) for s in samples]).alias("cores")
    points = materialize(stored.join(found.groupBy("id").agg(cores), "id"))
    n = points.count()
    numbers = F.array(*[F.lit(t) for t in range(len(samples))])
    member = points.select("id", F.explode(numbers).alias("tree"), F.col("id").alias("component"))
    schema = "tree int, component bigint, weight double, low bigint, high bigint, to_component bigint"
    trees, missing = [], len(samples) * (n - 1)
    while missing > 0:
        named = member.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "component"))), lambda c: c["component"]).alias("components"))
        state = materialize(points.join(named, "id"))
        partial = block_apply(state, state, kernels.outgoing_edges_kernel, schema, None, source_rows, block_rows, by_cells=True)
        best = partial.groupBy("tree", "component").agg(F.min(F.struct("weight", "low", "high", "to_component")).alias("e"))
        picked = materialize(best.select("tree", "component", "e.*"))
        edges = picked.select("tree", "low", "high", "weight").distinct()
        trees.append(edges)
        missing -= edges.count()
        if missing <= 0:
            break
        back = picked.select("tree", F.col("component").alias("to_component"), F.col("to_component").alias("back"))
        mutual = (F.col("back") == F.col("component")) & (F.col("component") < F.col("to_component"))
        parents = lookup_join(picked, back, ["tree", "to_component"], null_safe=False, row_id="component", stored=True).select(
            "tree", F.col("component").alias("id"), F.when(mutual, F.col("component")).otherwise(F.col("to_component")).alias("parent")
        )
        roots = shortcut(parents, ["tree"]).select("tree", F.col("id").alias("component"), F.col("parent").alias("root"))
        # a tree that is done has no edge left to take while another still grows: its points keep their component
        renamed = F.coalesce("root", "component").alias("component")
        member = materialize(lookup_join(member, roots, ["tree", "component"], null_safe=False, row_id="id", stored=True).select("id", "tree", renamed))
    if not trees:
        return df.sparkSession.createDataFrame([], "tree int, low bigint, high bigint, weight double")
    out = trees[0]
    for part in trees[1:]:
        out = out.unionByName(part)
    return materialize(out)


def mst_boruvka(df: DataFrame, min_samples: int, **limits: int) -> DataFrame:
    """Minimum spanning tree (low, high, weight) under mutual reachability."""
    return spanning_trees(df, [min_samples], **limits).drop("tree")


def density_hierarchy(df: DataFrame, min_cluster_size: int, min_samples: int | None = None, block_edges: int = BLOCK_EDGES, **limits: int) -> DataFrame:
    """(id, label): clusters of greatest stability over all radii (excess of mass), -1 for the rest."""
    return density_labels(df, [(min_cluster_size, min_samples)], block_edges, **limits).select("id", "label")


def density_labels(df: DataFrame, settings: list[tuple[int, int | None]], block_edges: int = BLOCK_EDGES, **limits: int) -> DataFrame:
    """(id, setting, label) for all (min_cluster_size, min_samples): one spanning tree per min_samples, one merge tree for all."""
    samples = sorted({s or size for size, s in settings})
    merged = merges(spanning_trees(df, samples, **limits), block_edges)
    return density_clusters(df.select("id"), merged, [(samples.index(s or size), size) for size, s in settings])


def param_sweep(df: DataFrame, settings: list[tuple[float, int]] = DBSCAN_GRID, **limits: int) -> DataFrame:
    """Quality of every density setting; clusterings and scores come from joint computations."""
    return radius_sweeps(df, {"DBSCAN": settings}, **limits)


def radius_sweeps(df: DataFrame, grids: dict[str, list[tuple[float, int]]], **limits: int) -> DataFrame:
    """The same for several named grids at once."""
    stored = materialize(df.select("id", "features"))
    every = [(model, eps, m) for model, grid in grids.items() for eps, m in grid]
    labels = materialize(dbscan_sweep(stored, [(eps, m) for _, eps, m in every], **limits))
    scores = score_settings(stored, labels, len(every), **limits)
    names = {"model": [model for model, _, _ in every], "param": [f"eps={eps},min={m}" for _, eps, m in every]}
    return scores.select(*[F.array(*map(F.lit, v))[F.col("setting")].alias(n) for n, v in names.items()], *[c for c in scores.columns if c != "setting"])


def density_sweep(df: DataFrame, settings: list[tuple[int, int | None]] = HDBSCAN_GRID, **limits: int) -> DataFrame:
    """Quality per (min_cluster_size, min_samples), noise left out."""
    stored = materialize(df.select("id", "features"))
    labels = materialize(density_labels(stored, settings, **limits))
    return _scored(stored, labels, "HDBSCAN", [f"mcs={size},ms={samples}" for size, samples in settings], **limits)


def microcluster_sweep(df: DataFrame, settings: list[tuple[float, int]] = MICROCLUSTER_GRID, n_init: int = 1, **limits: int) -> DataFrame:
    stored = materialize(df.select("id", "features"))
    labels = microcluster_labels(stored, settings, n_init)
    return _scored(stored, materialize(labels), "Birch", [f"k={k},thr={threshold}" for threshold, k in settings], **limits)


def _scored(points: DataFrame, labels: DataFrame, model: str, params: list[str], **limits: int) -> DataFrame:
    scores = score_settings(points, labels, len(params), **limits)
    return scores.select(F.lit(model).alias("model"), F.array(*map(F.lit, params))[F.col("setting")].alias("param"), *[c for c in scores.columns if c != "setting"])


def zone_points(rollup: DataFrame, features: list[str], zone: str = "square_id") -> DataFrame:
    """Numbered zone rows as (id, zone, features), null features as 0."""
    filled = rollup.withColumns({f: F.coalesce(F.col(f), F.lit(0.0)) for f in features})
    return global_index(filled, [zone], "id").select("id", zone, F.array(*[F.col(f).cast("double") for f in features]).alias("features"))


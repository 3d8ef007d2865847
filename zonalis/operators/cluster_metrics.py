"""Cluster quality. Input rows are (id, features array<double>, label); label -1 is noise and is left out."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.plans import kernels
from zonalis.plans.blocks import BLOCK_ROWS, SOURCE_ROWS, block_apply, is_broadcast
from zonalis.plans.materialize import materialize
from zonalis.plans.skew import lookup_join

OUTLIER_BELOW = -0.1
#: What a task may hold of all rows where it sums distances per atom, and about how many distances it looks at.
ATOM_ROWS, ATOM_BYTES, ATOM_LABELS, ATOM_PAIRS = 2_000_000, 128 << 20, 1 << 24, 1 << 28


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)


def silhouette_settings(rows: DataFrame, **limits: int) -> DataFrame:
    """(id, setting, label, silhouette) of stored rows (id, features, labels): exact Euclidean value per row and setting, 0 for
    a cluster of one, no rows below two clusters. Distances are computed once for all settings.

    A task that holds all rows returns one row per (row, setting), else one distance sum per (row, setting, cluster), never
    a distance per pair of rows. Rows with the same labels in all settings are summed up together (an atom), and clusters are
    added up from atoms.
    """
    value = F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    # rows that share an id are taken together, which needs the sums per cluster
    single = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR id IS NULL").isEmpty()
    schema = "id bigint, setting int, label bigint, size bigint, a double, b double"
    atoms = _atoms(rows, limits.get("source_rows", ATOM_ROWS)) if single else None
    if atoms:
        targets, kernel, tasks = atoms
        found = targets.repartition(tasks, "id").mapInPandas(kernel, schema)
        return found.select("id", "setting", "label", value.alias("silhouette"))
    if single and is_broadcast(rows, limits.get("source_rows", SOURCE_ROWS)):
        found = block_apply(rows, rows, kernels.own_and_next_kernel, schema, None, **limits)
        return found.select("id", "setting", "label", value.alias("silhouette"))
    schema = "id bigint, setting int, other_label bigint, total double, n bigint"
    partial = block_apply(rows, rows, kernels.label_sums_kernel, schema, None, **limits)
    sums = partial.groupBy("id", "setting", "other_label").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    joined = sums.join(rows.select("id", F.posexplode("labels").alias("setting", "label")).filter("label != -1"), ["id", "setting"])
    own = F.col("other_label") == F.col("label")
    per_row = joined.groupBy("id", "setting", "label").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    ).filter(F.col("b").isNotNull())
    return per_row.select("id", "setting", "label", value.alias("silhouette"))


def _atoms(rows: DataFrame, source_rows: int):
    """(rows with their atom, kernel over batches of them, tasks), or None where features or atoms are too many for a task."""
    first = rows.select(F.size("features").alias("width"), F.size("labels").alias("settings")).first()
    n = rows.count()
    if first is None or first.width is None or n > source_rows or n * first.width * 8 > ATOM_BYTES:
        return None
    inside = rows.filter(F.exists("labels", lambda x: x != -1))
    numbered = materialize(inside.select("labels").distinct().withColumn("__mid", F.monotonically_increasing_id()))
    if numbered.count() * first.settings > ATOM_LABELS:
        return None
    table = numbered.orderBy("__mid").toArrow()
    labels = table.column("labels").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), first.settings)
    names = numbered.sparkSession.createDataFrame([(m, i) for i, m in enumerate(table.column("__mid").to_pylist())], "__mid long, atom int")
    named = numbered.join(F.broadcast(names), "__mid").drop("__mid")
    targets = materialize(lookup_join(inside, named, ["labels"], null_safe=False, row_id="id").select("id", "features", "atom"))
    sources = targets.select("features", "atom").toArrow()
    points = sources.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(sources), first.width)
    held = rows.sparkSession.sparkContext.broadcast(kernels.by_atom(points, sources.column("atom").to_numpy(), labels))

    def run(batches):
        for batch in batches:
            if len(batch):
                yield kernels.own_and_next_by_atom(batch, held.value)

    return targets, run, max(1, min(1 + n * n // ATOM_PAIRS, 10_000))


def silhouette_samples(df: DataFrame, source_rows: int = SOURCE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, label, silhouette) of one labelling, noise left out; empty below two clusters."""
    rows = materialize(df.filter(F.col("label") != -1).select("id", "features", F.array(F.col("label").cast("long")).alias("labels")))
    return silhouette_settings(rows, source_rows=source_rows, block_rows=block_rows).drop("setting")


def silhouette(df: DataFrame, approx: bool = False, **limits: int) -> DataFrame:
    """One row with the mean silhouette; null when there are fewer than two clusters.

    ``approx`` uses squared distances, which need only cluster moments and so one pass over any number of rows.
    """
    if approx:
        usable = df.filter(F.col("label") != -1).select(array_to_vector("features").alias("features"), F.col("label").cast("int").alias("prediction"))
        if usable.select("prediction").distinct().limit(2).count() < 2:
            return df.sparkSession.createDataFrame([(None,)], "silhouette double")
        return df.sparkSession.createDataFrame([(float(ClusteringEvaluator().evaluate(usable)),)], "silhouette double")
    return silhouette_samples(df, **limits).agg(F.avg("silhouette").alias("silhouette"))


def flag_silhouette_outliers(df: DataFrame, below: float = OUTLIER_BELOW, **limits: int) -> DataFrame:
    return silhouette_samples(df, **limits).withColumn("is_outlier", F.col("silhouette") < below)


def centroids(df: DataFrame) -> DataFrame:
    """(label, n, centre) with one average per coordinate, so partial sums are combined before the shuffle."""
    usable = df.filter(F.col("label") != -1)
    first = usable.select(F.size("features")).first()
    width = first[0] if first else 0
    return usable.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("features")[i]) for i in range(width)]).alias("centre")
    )


def cluster_moments(df: DataFrame) -> DataFrame:
    """(label, n, centre, spread, within) per cluster, stored: mean distance and summed squared distance to the centre."""
    centres = materialize(centroids(df))
    joined = lookup_join(df.filter(F.col("label") != -1), centres.select("label", "centre"), ["label"], null_safe=False, stored=True)
    squared = squared_distance(F.col("features"), F.col("centre"))
    sums = joined.groupBy("label").agg(F.avg(F.sqrt(squared)).alias("spread"), F.sum(squared).alias("within"))
    return materialize(centres.join(sums, "label"))


def inertia(df: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    return (moments or cluster_moments(df)).agg(F.sum("within").alias("inertia"))


def davies_bouldin(df: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / distance; null below two clusters."""
    moments = moments or cluster_moments(df)
    return _worst_ratios(moments.withColumn("setting", F.lit(0))).agg(F.avg("worst").alias("davies_bouldin"))


def _worst_ratios(moments: DataFrame) -> DataFrame:
    """(setting, worst) per cluster, infinite ratios left out."""
    table = materialize(moments.select("setting", F.col("label").cast("long").alias("id"), F.col("centre").alias("features"), "spread"))
    found = block_apply(table, table, kernels.worst_ratio_kernel, "setting int, id bigint, worst double").groupBy("setting", "id").agg(F.max("worst").alias("worst"))
    return found.withColumn("worst", F.when(F.abs("worst") != float("inf"), F.col("worst")))


def calinski_harabasz(df: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    """(B / (k - 1)) / (W / (n - k)); null below two clusters."""
    moments = moments or cluster_moments(df)
    first = moments.first()
    width = len(first["centre"]) if first else 0
    overall = moments.agg(*[(F.sum(F.col("centre")[i] * F.col("n")) / F.sum("n")).alias(f"m{i}") for i in range(width)], F.lit(0)).first()
    mean = F.array(*[F.lit(overall[f"m{i}"]) for i in range(width)]).cast("array<double>")
    between = F.sum(F.col("n") * squared_distance(F.col("centre"), mean))
    k, n = F.count(F.lit(1)), F.sum("n")
    ratio = F.try_divide(between / F.nullif(k - 1, F.lit(0)), F.sum("within") / F.nullif(n - k, F.lit(0)))
    return moments.agg(F.when(k > 1, ratio).alias("calinski_harabasz"))


def generalization_ratio(df: DataFrame, train: str = "train_silhouette", test: str = "test_silhouette") -> DataFrame:
    """Test silhouette as a percentage of the training one."""
    return df.withColumn("generalization_pct", F.try_divide(F.col(test), F.col(train)) * 100)


def overfit_flag(df: DataFrame) -> DataFrame:
    """Test silhouette under half of the training one, or test error above 1.5 times the training error."""
    flags = []
    if {"train_silhouette", "test_silhouette"} <= set(df.columns):
        flags.append(F.coalesce(F.col("test_silhouette") < 0.5 * F.col("train_silhouette"), F.lit(False)))
    if {"train_mae", "test_mae"} <= set(df.columns):
        flags.append(F.coalesce(F.col("test_mae") > 1.5 * F.col("train_mae"), F.lit(False)))
    out = flags[0]
    for flag in flags[1:]:
        out = out | flag
    return df.withColumn("overfit", out)


def score_settings(points: DataFrame, labels: DataFrame, settings: int, **limits: int) -> DataFrame:
    """setting, n_clusters, n_outliers, silhouette, dbi, calinski_harabasz for settings 0, 1, ... in one go. Stored.

    ``points`` are (id, features), ``labels`` (id, setting, label) with a row per point and setting; -1 is noise.
    """
    spark = points.sparkSession
    wide = labels.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("setting", F.col("label").cast("long").alias("label")))), lambda p: p["label"]).alias("labels"))
    rows = materialize(points.select("id", "features").join(wide, "id"))
    every = spark.range(settings).select(F.col("id").cast("int").alias("setting"))
    first = rows.select(F.size("features")).first()
    width = first[0] if first else 0
    long = rows.select("features", F.posexplode("labels").alias("setting", "label"))
    centres = long.groupBy("setting", "label").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("features")[i]) for i in range(width)]).cast("array<double>").alias("centre"))
    centres = materialize(centres)
    noise = F.col("label") == -1
    counts = centres.groupBy("setting").agg(F.count_if(~noise).alias("n_clusters"), F.sum(F.when(noise, F.col("n")).otherwise(0)).alias("n_outliers"))
    real = centres.filter(~noise)
    joined = lookup_join(long.filter(~noise), real.select("setting", "label", "centre"), ["setting", "label"], null_safe=False, stored=True)
    squared = squared_distance(F.col("features"), F.col("centre"))
    sums = joined.groupBy("setting", "label").agg(F.avg(F.sqrt(squared)).alias("spread"), F.sum(squared).alias("within"))
    moments = materialize(real.join(sums, ["setting", "label"]))
    whole = moments.groupBy("setting").agg(F.array(*[F.sum(F.col("centre")[i] * F.col("n")) / F.sum("n") for i in range(width)]).cast("array<double>").alias("mean"))
    met = moments.join(F.broadcast(whole), "setting")  # a row per setting
    k, n = F.count(F.lit(1)), F.sum("n")
    between = F.sum(F.col("n") * squared_distance(F.col("centre"), F.col("mean")))
    ratio = F.try_divide(between / F.nullif(k - 1, F.lit(0)), F.sum("within") / F.nullif(n - k, F.lit(0)))
    ch = met.groupBy("setting").agg(F.when(k > 1, ratio).alias("calinski_harabasz"))
    dbi = _worst_ratios(moments).groupBy("setting").agg(F.avg("worst").alias("dbi"))
    sil = silhouette_settings(rows, **limits).groupBy("setting").agg(F.avg("silhouette").alias("silhouette"))
    out = every.join(counts, "setting", "left").join(sil, "setting", "left").join(dbi, "setting", "left").join(ch, "setting", "left")
    filled = {c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in ("n_clusters", "n_outliers")}
    return materialize(out.withColumns(filled).select("setting", "n_clusters", "n_outliers", "silhouette", "dbi", "calinski_harabasz"))


def score(df: DataFrame, **limits: int) -> DataFrame:
    """One row: clusters, noise, silhouette, dbi, calinski_harabasz of a labelled table."""
    stored = materialize(df.select("id", "features", F.lit(0).alias("setting"), "label"))
    return score_settings(stored, stored, 1, **limits).drop("setting")


def score_trials(train: DataFrame, test: DataFrame | None, trials: dict[tuple[str, str], tuple[DataFrame, DataFrame | None]], **limits: int) -> DataFrame:
    """Metrics per (model, param) of labellings (id, label) of the train points and, with ``test_`` before the names, of the test points."""
    names = list(trials)
    out = None
    for points, side, prefix in ((train, 0, ""), (test, 1, "test_")):
        if points is None:
            continue
        labels = None
        for i, name in enumerate(names):
            part = trials[name][side].select("id", F.lit(i).alias("setting"), F.col("label").cast("long").alias("label"))
            labels = part if labels is None else labels.unionByName(part)
        scores = score_settings(points, materialize(labels), len(names), **limits)
        scores = scores.withColumnsRenamed({c: f"{prefix}{c}" for c in scores.columns if c != "setting"})
        out = scores if out is None else out.join(scores, "setting")
    model, param = (F.array(*[F.lit(n[i]) for n in names])[F.col("setting")] for i in (0, 1))
    return out.withColumns({"model": model, "param": param}).select("model", "param", *[c for c in out.columns if c != "setting"])

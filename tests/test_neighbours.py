"""Neighbour joins, clustering and cluster quality against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonalis.operators import cluster_metrics as m
from zonalis.operators import clustering as cl
from zonalis.operators import neighbours as nb
from zonalis.operators.spatial import assign_by_bbox

BLOCKS = {"source_rows": 0, "block_rows": 15}


def blobs(seed=5, copies=20):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.25, (30, 3)) for c in ((0, 0, 0), (3, 3, 0), (0, 4, 2))] + [rng.uniform(-3, 7, (15, 3))])
    return np.concatenate([x, np.repeat(x[:1], copies, axis=0)])


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in r], *([int(labels[i])] if labels is not None else [])) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, features array<double>" + (", label int" if labels is not None else "")).cache()


def distances(x, y=None):
    y = x if y is None else y
    return np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_knn_join(spark, limits):
    x = blobs()
    df = frame(spark, x)
    got = nb.knn_join(df, df, 4, skip_self=True, **limits).orderBy("id", "neighbour").collect()
    d = np.round(distances(x), 9)
    np.fill_diagonal(d, np.inf)
    want = [(i, int(j), float(d[i, j])) for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), d[i]))[:4]]
    assert [(r.id, r.other) for r in got] == [(a, b) for a, b, _ in want]
    assert [r.distance for r in got] == pytest.approx([c for _, _, c in want], abs=1e-8)


def brute_dbscan(x, eps, min_samples):
    near = distances(x) <= eps
    core = near.sum(axis=1) >= min_samples
    labels, cluster = np.full(len(x), -1), 0
    for i in range(len(x)):
        if not core[i] or labels[i] >= 0:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] >= 0:
                continue
            labels[j] = cluster
            if core[j]:
                stack += [k for k in np.flatnonzero(near[j]) if labels[k] < 0]
        cluster += 1
    return labels


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_dbscan_matches_brute_force(spark, limits):
    x = blobs()
    settings = [(0.4, 3), (0.6, 5), (1.2, 4)]
    got = cl.dbscan_sweep(frame(spark, x), settings, **limits).collect()
    assert len(got) == len(x) * len(settings)
    for s, (eps, k) in enumerate(settings):
        labels = np.array([r.label for r in sorted((r for r in got if r.setting == s), key=lambda r: r.id)])
        assert labels.tolist() == brute_dbscan(x, eps, k).tolist()


def test_dbscan_without_core_points(spark):
    x = np.arange(10.0)[:, None] * 10
    assert {r.label for r in cl.dbscan(frame(spark, x), 1.0, 3).collect()} == {-1}


def brute_tree(x, min_samples):
    d = np.round(distances(x), 9)
    core = np.sort(d, axis=1)[:, min_samples - 1]
    reach = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    inside, edges = {0}, []
    while len(inside) < len(x):
        w, a, b = min((reach[i, j], i, j) for i in inside for j in range(len(x)) if j not in inside)
        edges.append((a, b, w))
        inside.add(j := b)
    return edges


def test_wide_points_by_products(spark):
    """Distances of wide points come from products, and exactly where that could matter: ties, copies, points on the radius."""
    from zonalis.plans import kernels

    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(100, 1, (500, 16)), np.round(rng.normal(100, 1, (300, 16)))])
    x = np.concatenate([x, np.repeat(x[510:511], 40, axis=0), x[:20]])
    ids = rng.permutation(len(x))
    table = kernels.pd.DataFrame({"id": ids, "features": list(x), "weight": rng.integers(1, 4, len(x)), "labels": list(rng.integers(-1, 60, (len(x), 3)))})
    d = kernels.euclid(x, x)
    for skip in (False, True):
        got = kernels.nearest_kernel(5, "euclid", skip)(table, table)
        want = np.round(d, 9)
        if skip:
            np.fill_diagonal(want, np.inf)
        rows, cols = kernels.smallest(want, ids, 5)
        assert sorted(zip(got.id, got.other, got.distance)) == sorted(zip(ids[rows], ids[cols], want[rows, cols]))
    radii = [float(d[510, 520]), 4.0, float(np.median(d))]
    degree = np.stack(kernels.degree_kernel(radii)(table, table).degree)
    assert degree.tolist() == np.stack([(d <= r) @ table.weight for r in radii], axis=1).tolist()
    first = np.where(rng.uniform(size=(len(x), 3)) < 0.02, ids[:, None] * 1.0, np.nan)
    least = kernels.least_label_kernel(radii, 1)(table.assign(labels=list(first)), table.assign(labels=list(first)))
    near = np.stack([np.where(d <= r, np.where(np.isnan(first[:, i]), np.inf, first[:, i])[None], np.inf).min(axis=1) for i, r in enumerate(radii)], axis=1)
    got = np.nan_to_num(np.stack(least.least), nan=np.inf)
    assert (np.isinf(got) == np.isinf(near)).all() and (got <= near).all()
    sums = kernels.label_sums_kernel(table, table).set_index(["id", "setting", "other_label"])
    given = np.stack(table.labels)
    for s, name in ((0, 5), (2, 59)):
        member = given[:, s] == name
        part = sums.xs((s, name), level=("setting", "other_label"))
        assert part.total.loc[ids].to_numpy() == pytest.approx(d[:, member].sum(axis=1), abs=1e-9)
        assert (part.n == member.sum()).all()


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_spanning_tree_weight(spark, limits):
    x = blobs(copies=3)
    got = cl.mst_boruvka(frame(spark, x), 3, **limits).collect()
    want = brute_tree(x, 3)
    assert len(got) == len(x) - 1
    assert sorted(r.weight for r in got) == pytest.approx(sorted(w for *_, w in want))
    parent = list(range(len(x)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in got:
        assert root(r.low) != root(r.high)
        parent[root(r.low)] = root(r.high)


def brute_hierarchy(x, min_cluster_size, min_samples):
    """Condensed tree and excess of mass from the definition: remove edges from heavy to light."""
    edges = sorted(brute_tree(x, min_samples), key=lambda e: -e[2])
    levels = sorted({w for *_, w in edges if w > 0}, reverse=True)

    def parts(members, eps):
        members, out = set(members), []
        links = {i: [] for i in members}
        for a, b, w in edges:
            if w <= eps and a in members and b in members:
                links[a].append(b)
                links[b].append(a)
        while members:
            stack, seen = [min(members)], set()
            while stack:
                i = stack.pop()
                if i not in seen:
                    seen.add(i)
                    stack += links[i]
            members -= seen
            out.append(seen)
        return out

    def grow(members, birth, at):
        """(stability, own members, children) of the cluster that starts with ``members`` at ladder position ``at``."""
        first, stability, children = set(members), 0.0, []
        while True:
            lam = 1 / levels[at]
            if at + 1 == len(levels):
                stability += len(members) * (lam - birth)
                break
            big = [q for q in parts(members, levels[at + 1]) if len(q) >= min_cluster_size]
            if len(big) == 1:
                stability += (len(members) - len(big[0])) * (lam - birth)
                members, at = big[0], at + 1
                continue
            stability += len(members) * (lam - birth)
            children = [grow(q, lam, at + 1) for q in big]
            break
        return stability, first, children

    def select(node, is_root):
        stability, first, children = node
        below = [select(c, False) for c in children]
        total = sum(b[0] for b in below)
        if not is_root and stability >= total:
            return stability, [first]
        return total, [s for b in below for s in b[1]]

    whole = parts(range(len(x)), levels[0])
    roots = [q for q in whole if len(q) >= min_cluster_size]
    chosen = [s for q in roots for s in select(grow(q, 0.0, 0), True)[1]]
    labels = np.full(len(x), -1)
    for n, members in enumerate(sorted(chosen, key=min)):
        labels[list(members)] = n
    return labels


def test_density_hierarchy_matches_definition(spark):
    x = blobs(seed=8, copies=0)[::2]
    got = cl.density_hierarchy(frame(spark, x), 5, 3).orderBy("id").collect()
    assert [r.label for r in got] == brute_hierarchy(x, 5, 3).tolist()
    assert len({r.label for r in got}) > 2


@pytest.mark.parametrize("block_edges", [500_000, 40])
def test_density_hierarchy_of_many_weights(spark, monkeypatch, block_edges):
    from zonalis.plans import merge_tree

    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in [((0, 0), 0.3, 150), ((4, 0), 0.6, 150), ((0, 5), 0.15, 80), ((0.4, 5.6), 0.15, 60), ((2, 2), 3.0, 60)]])
    if block_edges < 100:  # ties in great number, copies, and clusters chosen level by level
        x = np.round(x * 2) / 2
        monkeypatch.setattr(merge_tree.choose_stable, "__defaults__", (0,))
        monkeypatch.setattr(merge_tree.density_clusters, "__defaults__", (0,))
        x = x[::3]
    df = frame(spark, x)
    settings = [(5, 3)] if block_edges > 100 else [(5, 3), (12, None), (25, 5)]
    tree = cl.spanning_trees(df, [3])
    weights = tree.filter("tree = 0").select("weight").distinct().count()
    assert weights > 300 or block_edges < 100
    got = {(r.setting, r.id): r.label for r in cl.density_labels(df, settings, block_edges).collect()}
    for i, (size, samples) in enumerate(settings):
        want = brute_hierarchy(x, size, samples or size)
        assert [got[i, j] for j in range(len(x))] == want.tolist(), (size, samples)
    assert len({v for (i, _), v in got.items() if i == 0}) > 2


def test_spanning_trees_that_end_in_different_rounds(spark):
    x = np.array([0.0, 1, 10, 11, 30, 31, 50, 51])[:, None]
    trees = cl.spanning_trees(frame(spark, x), [2, 8]).collect()
    for t, samples in enumerate((2, 8)):
        assert sorted(r.weight for r in trees if r.tree == t) == pytest.approx(sorted(w for *_, w in brute_tree(x, samples)))


def test_spanning_tree_skips_most_pairs():
    from zonalis.plans import kernels
    from zonalis.plans.cells import Cells, LightestEdges

    rng = np.random.default_rng(5)
    x = rng.uniform(0, 1, (20_000, 2))
    sides = {"id": np.arange(len(x)), "core": np.full((len(x), 1), 0.004), "component": np.arange(len(x))[:, None]}
    search = LightestEdges(kernels.euclid)
    found = search.find(sides, sides, Cells(x), Cells(x))[0]
    assert len(found[0]) == len(x) and search.pairs < 0.05 * len(x) ** 2
    some = rng.choice(len(x), 200, replace=False)
    d = np.maximum(kernels.euclid(x[some], x), 0.004)
    d[np.arange(200), some] = np.inf
    assert found[1][some] == pytest.approx(d.min(axis=1))
    frame_ = kernels.pd.DataFrame({"id": np.arange(len(x))})
    rows, others, distance, pairs = kernels.nearest_in_cells(x[:2000], frame_[:2000], frame_, x, 5, 9, False)
    assert pairs < 0.1 * 2000 * len(x) and len(rows) == 10_000


def test_all_starts_share_passes(spark):
    from zonalis.plans.lloyd import lloyd, spread_starts
    from zonalis.plans.materialize import materialize

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.4, (60, 3)) for c in (0, 3, 7)])
    rows = materialize(frame(spark, x).withColumn("weight", F.lit(1.0)))
    fits = lloyd(rows, [2, 3, 5], 4)
    for k, fit in zip([2, 3, 5], fits):
        costs = []
        order = [r.id for r in rows.orderBy(F.xxhash64("id", F.lit(42)), "id").collect()]
        for start in range(4):
            c = spread_starts(x[order], np.ones(len(x)), k, np.random.default_rng([42, k, start]))
            for _ in range(300):
                near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
                moved = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
                if np.sqrt(((moved - c) ** 2).sum(1)).max() <= 1e-4:
                    break
                c = moved
            costs.append(((x - c[near]) ** 2).sum())
        assert fit.cost == pytest.approx(min(costs))
    assert lloyd(materialize(rows.limit(0)), [2], 1)[0].centres == []
    assert len(lloyd(materialize(rows.withColumn("features", F.array(F.lit(1.0)))), [4], 2)[0].centres) == 1


def test_scores_of_many_settings_equal_single_ones(spark):
    x = blobs()
    df = frame(spark, x)
    given = [np.array([i % 3 for i in range(len(x))]), np.full(len(x), -1), np.zeros(len(x), int), np.array([-1 if i % 5 == 0 else i % 4 for i in range(len(x))])]
    labels = spark.createDataFrame([(i, s, int(v)) for s, g in enumerate(given) for i, v in enumerate(g)], "id long, setting int, label int")
    got = {r.setting: r for r in m.score_settings(df, labels, 4).collect()}
    for s, g in enumerate(given):
        one = m.score(frame(spark, x, g)).first()
        assert (got[s].n_clusters, got[s].n_outliers) == (len(set(g) - {-1}), (g == -1).sum()) == (one.n_clusters, one.n_outliers)
        for c in ("silhouette", "dbi", "calinski_harabasz"):
            assert got[s][c] == pytest.approx(one[c]) if one[c] is not None else got[s][c] is None
    assert got[0].silhouette == pytest.approx(brute_silhouette(x, given[0]).mean()) and got[1].silhouette is None and got[2].dbi is None


def test_silhouettes_of_very_many_clusters():
    """A task that holds all rows hands on one row per row and setting, however many clusters there are."""
    from zonalis.plans import kernels

    rng = np.random.default_rng(12)
    x, labels = rng.normal(0, 1, (400, 4)), np.stack([rng.integers(-1, 150, 400), rng.integers(0, 3, 400)], axis=1)
    table = kernels.pd.DataFrame({"id": np.arange(400), "features": list(x), "labels": list(labels)})
    got = kernels.own_and_next_kernel(table, table).set_index(["setting", "id"])
    assert len(got) == (labels != -1).sum()
    d = distances(x)
    for s in (0, 1):
        for i in range(0, 400, 7):
            own = labels[i, s]
            if own == -1:
                continue
            mine = labels[:, s] == own
            r = got.loc[s, i]
            assert r["size"] == mine.sum() and r.label == own
            assert r.b == pytest.approx(min(d[i, labels[:, s] == o].mean() for o in set(labels[:, s]) - {-1, own}))
            assert mine.sum() == 1 or r.a == pytest.approx(d[i, mine].sum() / (mine.sum() - 1))


def test_endless_radius_is_one_cluster(spark):
    df = frame(spark, np.array([[0.0], [1.0], [50.0], [50.5]]))
    got = {(r.setting, r.id): r.label for r in cl.dbscan_sweep(df, [(float("inf"), 5), (0.6, 2), (float("inf"), 4)]).collect()}
    assert [got[0, i] for i in range(4)] == [-1] * 4 and [got[2, i] for i in range(4)] == [0] * 4
    assert [got[1, i] for i in range(4)] == [-1, -1, 0, 0]


def brute_silhouette(x, labels):
    d, out = distances(x), []
    for i in range(len(x)):
        own = (labels == labels[i])
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == other].mean() for other in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_silhouette(spark, limits):
    x = blobs()
    labels = np.array([i % 4 for i in range(len(x))])
    labels[:30], labels[-1] = 0, 9
    noisy = labels.copy()
    noisy[5:9] = -1
    kept = noisy != -1
    got = m.silhouette_samples(frame(spark, x, noisy), **limits).orderBy("id").collect()
    assert [r.silhouette for r in got] == pytest.approx(brute_silhouette(x[kept], noisy[kept]).tolist())
    assert m.silhouette(frame(spark, x, np.zeros(len(x))), **limits).first()[0] is None
    assert m.silhouette(frame(spark, x, np.full(len(x), -1)), **limits).first()[0] is None


def test_moment_metrics(spark):
    x = blobs()
    labels = np.array([i % 3 for i in range(len(x))])
    df = frame(spark, x, labels)
    centre = np.array([x[labels == k].mean(axis=0) for k in range(3)])
    spread = np.array([np.sqrt(((x[labels == k] - centre[k]) ** 2).sum(axis=1)).mean() for k in range(3)])
    d = distances(centre)
    worst = [max((spread[i] + spread[j]) / d[i, j] for j in range(3) if j != i) for i in range(3)]
    within = sum(((x[labels == k] - centre[k]) ** 2).sum() for k in range(3))
    between = sum((labels == k).sum() * ((centre[k] - x.mean(axis=0)) ** 2).sum() for k in range(3))
    assert m.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))
    assert m.inertia(df).first()[0] == pytest.approx(within)
    assert m.calinski_harabasz(df).first()[0] == pytest.approx((between / 2) / (within / (len(x) - 3)))


def test_knn_assign_majority_and_ties(spark):
    train = frame(spark, np.array([[0.0], [1.0], [2.0], [10.0], [11.0]]), [1, 0, -1, 2, 2])
    test = frame(spark, np.array([[0.4], [10.4]]))
    assert [r.label for r in nb.assign_to_clusters(train, test, 1).orderBy("id").collect()] == [1, 2]
    assert [r.label for r in nb.assign_to_clusters(train, test, 2).orderBy("id").collect()] == [0, 2]
    noise = frame(spark, np.array([[0.0]]), [-1])
    assert {r.label for r in nb.assign_to_clusters(noise, test).collect()} == {-1}


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_knn_impute(spark, limits):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (60, 3))
    x[rng.random((60, 3)) < 0.25] = np.nan
    columns = ["a", "b", "c"]
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "id_ long, a double, b double, c double")
    got = np.array([[np.nan if v is None else v for v in r] for r in nb.knn_impute(df, df, "id_", columns, 4, **limits).orderBy("id_").select(*columns).collect()])
    want = x.copy()
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            near = []
            for k in range(len(x)):
                common = ~np.isnan(x[i]) & ~np.isnan(x[k])
                if not np.isnan(x[k, j]) and common.any():
                    near.append((round(float(np.sqrt(3 * ((x[i] - x[k])[common] ** 2).sum() / common.sum())), 9), k))
            if near:
                want[i, j] = np.mean([x[k, j] for _, k in sorted(near)[:4]])
    assert got == pytest.approx(want, nan_ok=True)


def brute_vote(known, zones, lat, lon, k=7):
    a, b = np.radians([lat, lon]), np.radians(known)
    d = 2 * np.arcsin(np.sqrt(np.sin((b[:, 0] - a[0]) / 2) ** 2 + np.cos(a[0]) * np.cos(b[:, 0]) * np.sin((b[:, 1] - a[1]) / 2) ** 2))
    d = np.round(d, 12)
    order = sorted(range(len(d)), key=lambda i: (d[i], zones[i]))[:k]
    votes = {}
    zero = any(d[i] == 0 for i in order)
    for i in order:
        votes[zones[i]] = votes.get(zones[i], 0) + (float(d[i] == 0) if zero else 1 / d[i])
    best = min(votes, key=lambda z: (-votes[z], z))
    return best if votes[best] / sum(votes.values()) >= 0.6 else None


@pytest.mark.parametrize("step", [1, 50])
def test_donors_by_pattern_equal_all_pairs(step):
    """The search by patterns finds what comparing all pairs finds, ties and copies included, without comparing them all."""
    from zonalis.plans import kernels

    rng = np.random.default_rng(4)
    x = np.round(rng.uniform(0, 100, (3000, 4)) / step) * step
    x[:, 1:][rng.uniform(size=(3000, 3)) < 0.2] = np.nan
    x[7] = np.nan
    table = kernels.pd.DataFrame({"id": rng.permutation(3000), "features": list(x)})
    table["copies"] = [[i] if i % 9 else [i, i + 5000] for i in table.id]
    targets = table[:400][["id", "features"]]
    order = ["id", "position", "distance", "other", "value"]
    compared = []
    plain = kernels.euclid
    kernels.euclid = lambda a, b, *more: compared.append(len(a) * len(b)) or plain(a, b, *more)
    try:
        got = kernels.donors_kernel(5)(targets, table)
    finally:
        kernels.euclid = plain
    far = table.copy()
    far.loc[3000] = [9999, np.array([np.inf, 0.0, 0.0, 0.0]), [9999]]  # an infinite value makes it compare all pairs
    want = kernels.donors_kernel(5)(targets, far)
    assert sorted(got[order].itertuples(index=False)) == sorted(want[order].itertuples(index=False)) and len(got) > 1000
    assert step > 1 or sum(compared) < 0.6 * 400 * 3000


def test_gappy_rows_that_share_an_id_are_filled_alike(spark):
    rows = [(i, float(i), 10.0 * i) for i in range(10)] + [(50, 2.0, None), (50, 7.0, None), (51, 2.0, None), (None, 2.0, None)]
    df = spark.createDataFrame(rows, "event long, a double, b double")
    train = df.filter("event < 10")
    got = nb.knn_impute(train, df, "event", ["a", "b"], 2).filter("event IS NULL OR event >= 10").collect()
    assert sorted((r.event or 0, r.a, r.b or 0.0) for r in got) == [(0, 2.0, 0.0), (50, 2.0, 45.0), (50, 7.0, 45.0), (51, 2.0, 15.0)]


def test_equal_gaps_are_solved_once(spark, monkeypatch):
    met = []
    plain = nb.block_apply
    monkeypatch.setattr(nb, "block_apply", lambda t, s, *more: met.append((t.count(), s.count())) or plain(t, s, *more))
    rows = [(i, float(i % 3), None if i % 2 else 2.0 * (i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "event long, a double, b double")
    got = nb.knn_impute(df, df, "event", ["a", "b"], 2).collect()
    assert sorted((r.event, r.a, r.b) for r in got) == [(i, a, 2.0 * a) for i, a, _ in rows]
    assert met == [(3, 6)]


@pytest.mark.parametrize("limits", [{}, BLOCKS])
def test_haversine_vote(spark, limits):
    rng = np.random.default_rng(9)
    known = np.concatenate([rng.uniform(50, 50.2, (80, 2)), np.repeat([[50.1, 50.1]], 40, axis=0)])
    zones = [f"z{int(p[0] * 20) % 3}" for p in known[:80]] + ["z9"] * 40
    asked = np.concatenate([rng.uniform(50, 50.2, (20, 2)), [[50.1, 50.1], [50.1001, 50.1]]])
    k = spark.createDataFrame([(i, float(p[0]), float(p[1]), z) for i, (p, z) in enumerate(zip(known, zones))], "row long, latitude double, longitude double, square_id string")
    u = spark.createDataFrame([(i, float(p[0]), float(p[1]), "Unknown") for i, p in enumerate(asked)], "row long, latitude double, longitude double, square_id string")
    got = {r.row: r.knn_zone for r in nb.knn_haversine_classify(k, u, "row", **limits).collect()}
    assert [got[i] for i in range(len(asked))] == [brute_vote(known, zones, *p) for p in asked]


def test_box_of_smallest_area(spark):
    rng = np.random.default_rng(6)
    boxes = [(f"z{i}", *map(float, (a, a + s, b, b + t))) for i, (a, b, s, t) in enumerate(zip(rng.uniform(0, 10, 40), rng.uniform(0, 10, 40), rng.exponential(1, 40), rng.exponential(1, 40)))]
    boxes += [("point", 5.0, 5.0, 5.0, 5.0), ("all", -100.0, 100.0, -100.0, 100.0)]
    points = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(-1, 12, (200, 2)))] + [(200, 5.0, 5.0), (201, 500.0, 0.0), (202, None, 1.0)]
    got = assign_by_bbox(
        spark.createDataFrame(points, "i long, latitude double, longitude double"),
        spark.createDataFrame(boxes, "square_id string, lat_min double, lat_max double, lon_min double, lon_max double"),
    )
    for r in got.collect():
        hits = [] if r.latitude is None else [b for b in boxes if b[1] <= r.latitude <= b[2] and b[3] <= r.longitude <= b[4]]
        want = min(hits, key=lambda b: ((b[2] - b[1]) * (b[4] - b[3]), b[0]))[0] if hits else None
        assert r.bbox_zone == want


def test_equal_boxes_are_filed_once(spark, monkeypatch):
    from zonalis.operators import spatial

    stored = []
    keep = spatial.materialize
    monkeypatch.setattr(spatial, "materialize", lambda df: stored.append(keep(df)) or stored[-1])
    boxes = spark.createDataFrame([(f"z{i}", 0.0, 1.0, 0.0, 1.0) for i in range(50, 0, -1)], "square_id string, lat_min double, lat_max double, lon_min double, lon_max double")
    points = spark.createDataFrame([(i, 0.5, 0.5) for i in range(30)] + [(30, 2.5, 0.5)], "i long, latitude double, longitude double")
    got = assign_by_bbox(points, boxes).collect()
    assert {r.i: r.bbox_zone for r in got} == {i: "z1" for i in range(30)} | {30: None} and len(got) == 31
    assert max(r.n for df in stored if "boxes" in df.columns for r in df.select(F.size("boxes").alias("n")).collect()) == 1


def test_zones_when_boxes_settle_every_row(spark):
    from zonalis.operators.spatial import impute_unknown_zones

    rows = [(i, 50 + i % 3 * 0.1, 8 + i % 5 * 0.1, "z") for i in range(30)] + [(30, 50.1, 8.1, None)]
    df = spark.createDataFrame(rows, "row long, latitude double, longitude double, square_id string")
    got = impute_unknown_zones(df, "row", source_rows=0, block_rows=4).collect()
    assert sorted((r.row, r.square_id) for r in got) == [(i, "z") for i in range(31)]


def test_microclusters_label_every_row(spark):
    x = blobs()
    out = cl.cf_microcluster(frame(spark, x), 0.5, 3).orderBy("id").collect()
    assert len(out) == len(x) and {r.label for r in out} == {0, 1, 2}
    assert len({r.label for r in out[:30]}) == 1


def test_kmeans_is_reproducible(spark):
    df = frame(spark, blobs())
    a, _, first = cl.kmeans_fit_assign(df, None, 3, n_init=3)
    b, _, second = cl.kmeans_fit_assign(df, None, 3, n_init=3)
    assert first == pytest.approx(second)
    assert [r.label for r in a.orderBy("id").collect()] == [r.label for r in b.orderBy("id").collect()]


def test_far_cells_are_settled_unseen(spark, monkeypatch):
    """Targets of a task lie near each other, and a count ends at the number asked for, so few distances are computed."""
    from zonalis.plans import blocks, kernels

    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, (100, 2)) for c in rng.uniform(-60, 60, (40, 2))])
    df = frame(spark, rng.permutation(x))
    monkeypatch.setattr(blocks, "PLACE_ROWS", 100)
    dealt = blocks.by_place(df, 40).withColumn("part", F.spark_partition_id())
    sides = dealt.groupBy("part").agg(*[(F.max(F.col("features")[j]) - F.min(F.col("features")[j])).alias(f"w{j}") for j in (0, 1)])
    assert sides.agg(F.avg(F.col("w0") * F.col("w1"))).first()[0] < 120 * 120 / 10
    pairs = []
    kept = kernels.euclid
    monkeypatch.setattr(kernels, "euclid", lambda a, b, stretch=1.0: pairs.append(len(a) * len(b)) or kept(a, b, stretch))
    table = kernels.pd.DataFrame({"id": np.arange(len(x)), "features": list(x), "weight": 1, "labels": [[float(i)] for i in range(len(x))]})
    degree = np.stack(kernels.degree_kernel([2.0], [3])(table, table.copy()).degree)[:, 0]
    assert ((degree >= 3) == ((distances(x) <= 2.0).sum(axis=1) >= 3)).all()
    links = kernels.links_kernel([2.0])(table, table.copy())
    assert sum(pairs) < len(x) ** 2 / 8
    root = np.arange(len(x))
    for a, b in zip(links.a, links.b):
        root[root == root[b]] = root[a]
    assert len(set(root.tolist())) == len(set(brute_dbscan(x, 2.0, 1).tolist())) and len(links) == len(x) - len(set(root.tolist()))


def test_dbscan_of_many_tasks(spark, monkeypatch):
    """Clusters that cross tasks and blocks, border points, copies and noise, several settings."""
    from zonalis.plans import blocks

    monkeypatch.setattr(cl, "PLACE_ROWS", 40)
    monkeypatch.setattr(blocks, "PLACE_ROWS", 40)
    rng = np.random.default_rng(9)
    line = np.stack([np.linspace(0, 40, 160), np.zeros(160)], axis=1)
    x = rng.permutation(np.concatenate([line, rng.uniform(-5, 45, (60, 2)), np.repeat([[9.0, 9.0]], 5, axis=0)]))
    settings = [(0.3, 2), (0.3, 4), (1.5, 8)]
    got = cl.dbscan_sweep(frame(spark, x).repartition(3), settings).collect()
    for s, (eps, k) in enumerate(settings):
        labels = [r.label for r in sorted((r for r in got if r.setting == s), key=lambda r: r.id)]
        assert labels == brute_dbscan(x, eps, k).tolist()


def test_silhouette_sources_are_prepared_once(monkeypatch):
    """Tasks of a worker share what depends on the sources alone; the sums are those of a fresh table."""
    from zonalis.plans import kernels

    rng = np.random.default_rng(3)
    x, labels = rng.normal(0, 1, (300, 4)), rng.integers(-1, 4, (300, 3))
    table = kernels.pd.DataFrame({"id": np.arange(300), "features": list(x), "labels": list(labels)})
    made, kept = [], kernels._label_plans
    monkeypatch.setattr(kernels, "_label_plans", lambda given: made.append(1) or kept(given))
    shared = table.copy()
    parts = [kernels.own_and_next_kernel(table[at : at + 50], shared) for at in range(0, 300, 50)]
    assert len(made) == 1
    whole = kernels.own_and_next_kernel(table, table.copy())
    got = kernels.pd.concat(parts).sort_values(["setting", "id"])
    want = whole.sort_values(["setting", "id"])
    assert got[["id", "setting", "label", "size"]].to_numpy().tolist() == want[["id", "setting", "label", "size"]].to_numpy().tolist()
    assert np.allclose(got[["a", "b"]].to_numpy(), want[["a", "b"]].to_numpy(), equal_nan=True)


def test_starts_in_tasks_equal_passes(spark, monkeypatch):
    from zonalis.plans import lloyd as ll
    from zonalis.plans.materialize import materialize

    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, 0.4, (150, 2)) for c in (0.0, 4.0, 9.0)])
    rows = materialize(spark.createDataFrame([(i, p.tolist(), 1.0 + i % 3, i % 2) for i, p in enumerate(x)], "id long, features array<double>, weight double, part int").repartition(4))
    for parts in (None, [0, 1, 1]):
        monkeypatch.setattr(ll, "RUN_BYTES", 1 << 20)
        one = ll.lloyd(rows, [2, 3, 4], 2, parts=parts)
        monkeypatch.setattr(ll, "RUN_BYTES", 0)
        for a, b in zip(one, ll.lloyd(rows, [2, 3, 4], 2, parts=parts), strict=True):
            assert np.allclose(a.centres, b.centres) and a.cost == pytest.approx(b.cost)


def test_silhouettes_by_atoms_equal_those_of_blocks(spark, monkeypatch):
    from zonalis.plans.materialize import materialize

    rng = np.random.default_rng(12)
    x = rng.random((700, 3))
    labels = np.stack([rng.integers(-1, 5, 700), np.full(700, -1), rng.integers(0, 200, 700), np.zeros(700, int)], axis=1)
    rows = materialize(spark.createDataFrame([(i, p.tolist(), [int(v) for v in labels[i]]) for i, p in enumerate(x)], "id long, features array<double>, labels array<long>"))
    assert m._atoms(rows, 700) is not None and m._atoms(rows, 699) is None
    monkeypatch.setattr(m, "ATOM_PAIRS", 100_000)
    got = {(r.id, r.setting): (r.label, r.silhouette) for r in m.silhouette_settings(rows).collect()}
    want = {(r.id, r.setting): (r.label, r.silhouette) for r in m.silhouette_settings(rows, source_rows=100, block_rows=300).collect()}
    assert got.keys() == want.keys() and {s for _, s in got} == {0, 2}
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)
    assert [got[i, 0][1] for i in range(700) if labels[i, 0] >= 0] == pytest.approx(brute_silhouette(x[labels[:, 0] >= 0], labels[labels[:, 0] >= 0, 0]).tolist())


def test_donors_along_a_column_equal_brute_force(spark, monkeypatch):
    from zonalis.plans import blocks

    rng = np.random.default_rng(13)
    x = np.round(rng.random((600, 4)) * [50, 5, 5, 5], 2)
    x[rng.random((600, 4)) < [0.03, 0.2, 0.3, 0.2]] = np.nan
    x[:, 3][50:] = np.nan
    x[46:50, 3], x[3] = np.nan, [1e4, np.nan, np.nan, np.nan]
    x[x[:, 3] > 0.5, 3] = np.nan  # fewer donors than k
    frame_of = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "id long, a double, b double, c double, d double")
    names = list("abcd")
    seen, slabs = [], blocks._against_blocks
    monkeypatch.setattr(blocks, "_against_blocks", lambda t, s, *rest: seen.append(rest[2]) or slabs(t, s, *rest))
    train = frame_of.filter("id < 400")
    plain = {r.id: tuple(r) for r in nb.knn_impute(train, frame_of, "id", names).collect()}
    assert not seen
    got = {r.id: tuple(r) for r in nb.knn_impute(train, frame_of, "id", names, source_rows=50, block_rows=40).collect()}
    assert [r for r in seen if r] and len(got) == 600  # searched by reach
    for i in range(600):
        assert got[i] == pytest.approx(plain[i]), i
    # rows that share an id
    twice = frame_of.unionByName(frame_of.filter("id % 7 = 0").withColumn("a", F.col("a") + 3))
    key = lambda r: tuple((v is not None, v or 0.0) for v in r)
    a, b = (sorted((tuple(r) for r in nb.knn_impute(train, twice, "id", names, **limits).collect()), key=key) for limits in ({}, {"source_rows": 50, "block_rows": 40}))
    assert len(a) == len(b) and all(p == pytest.approx(q) for p, q in zip(a, b))


def test_wide_clusters_with_sources_in_pieces(spark, monkeypatch):
    from zonalis.plans import blocks

    rng = np.random.default_rng(14)
    x = np.concatenate([rng.normal(c, 0.1, (60, 12)) for c in (0.0, 2.0)] + [np.linspace(0, 2, 25)[:, None] * np.ones((1, 12)) + 4, rng.uniform(-9, 9, (20, 12))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, features array<double>")
    pieces, shuffled = [], []
    plain = blocks._against_pieces
    monkeypatch.setattr(blocks, "_against_pieces", lambda *a: pieces.append(a[-1]) or plain(*a))
    monkeypatch.setattr(blocks, "_against_blocks", lambda *a: shuffled.append(a))
    for eps, least in ((0.6, 4),):
        want = {r.id: r.label for r in cl.dbscan(df, eps, least).collect()}
        assert not pieces
        got = {r.id: r.label for r in cl.dbscan(df, eps, least, source_rows=0, block_rows=100).collect()}
        assert got == want and len(set(want.values())) > 2 and len(pieces) > 1 and not shuffled
        pieces.clear()

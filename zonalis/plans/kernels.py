"""Small array helpers that run inside tasks on one block of targets against one block of sources.

The module is pickled by value with the functions that use it, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from zonalis.plans.cells import LEAF, Cells, LightestEdges, cells_of, kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 4_000_000


def matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=float) if len(column) else np.zeros((0, 0))


def points_of(sources: pd.DataFrame) -> np.ndarray:
    """The features of a table that several calls in one worker share."""
    return kept(sources, "features", lambda: matrix(sources.features))


def euclid(a: np.ndarray, b: np.ndarray, stretch: float = 1.0) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(total if stretch == 1.0 else total * stretch)


#: From this many coordinates on boxes hardly shut anything out, and distances are taken from products of matrices.
WIDE = 9
WIDE_ROWS, WIDE_COLUMNS = 256, 4096


class Products:
    """Squared distances of wide points as products, with the bound of their error; pairs that need it are measured exactly."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        fine = b[np.isfinite(b).all(axis=1)]
        middle = fine.mean(axis=0) if len(fine) else 0.0
        self.exact = (a, b)
        self.a, self.b = a - middle, b - middle
        self.aa, self.bb = (self.a**2).sum(axis=1), (self.b**2).sum(axis=1)
        self.error = 1e-15 * (a.shape[1] + 8) * sum(x[np.isfinite(x)].max(initial=0.0) for x in (self.aa, self.bb))

    def squares(self, rows: slice, cols: slice) -> np.ndarray:
        d = self.a[rows] @ self.b[cols].T
        d *= -2.0
        d += self.aa[rows, None]
        d += self.bb[None, cols]
        return d

    def distances(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        """Exact distances of single pairs, summed in the order of ``euclid``."""
        a, b = self.exact
        total = np.zeros(len(rows))
        for j in range(a.shape[1]):
            total += (a[rows, j] - b[cols, j]) ** 2
        return np.sqrt(total)

    def within(self, rows: slice, cols: slice, radii: list[float]) -> list[np.ndarray]:
        """Per radius which pairs are no farther apart."""
        d, out = self.squares(rows, cols), []
        for radius in radii:
            near = d <= radius * radius
            r, c = np.nonzero(np.abs(d - radius * radius) <= 2 * self.error + 1e-15 * radius * radius)
            near[r, c] = self.distances(r + rows.start, c + cols.start) <= radius
            out.append(near)
        return out

    def roots(self, rows: slice, cols: slice) -> np.ndarray:
        """All distances, those that products give badly measured exactly."""
        d = self.squares(rows, cols)
        r, c = np.nonzero(d <= 1e6 * self.error)
        np.sqrt(np.maximum(d, 0.0, out=d), out=d)
        for at in range(0, len(r), CELLS):
            some = slice(at, at + CELLS)
            d[r[some], c[some]] = self.distances(r[some] + rows.start, c[some] + cols.start)
        return d


def pieces(n: int, step: int):
    return (slice(i, min(n, i + step)) for i in range(0, n, step))


def nearest_by_products(a: np.ndarray, tid: np.ndarray, b: np.ndarray, sid: np.ndarray, k: int, places: int, skip_self: bool):
    """(rows, ids, distances) of the k nearest: products leave few candidates, and those are measured."""
    products = Products(a, b)
    margin = 2 * 10.0**-places
    out = []
    for rows in pieces(len(a), WIDE_ROWS):
        size = rows.stop - rows.start
        best, names = np.full((size, k), np.inf), np.full((size, k), np.iinfo(np.int64).max)
        for cols in pieces(len(b), WIDE_COLUMNS):
            d = products.squares(rows, cols)
            if skip_self:
                d[tid[rows][:, None] == sid[cols][None, :]] = np.inf
            limit = (best[:, -1] + margin) ** 2
            if not np.isfinite(limit).all() and d.shape[1] > k:
                first = (np.sqrt(np.maximum(np.partition(d, k - 1, axis=1)[:, k - 1], 0.0) + 2 * products.error) + margin) ** 2
                limit = np.fmin(limit, first)
            r, c = np.nonzero((d <= limit[:, None] + 2 * products.error) & np.isfinite(d))
            if not len(r):
                continue
            measured = np.round(products.distances(r + rows.start, c + cols.start), places)
            some = np.unique(r)
            held = np.isfinite(best[some])
            r = np.concatenate([r, np.repeat(some, held.sum(axis=1))])
            measured, ids = np.concatenate([measured, best[some][held]]), np.concatenate([sid[cols][c], names[some][held]])
            order = np.lexsort((ids, measured, r))
            r, measured, ids = r[order], measured[order], ids[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            kept = place < k
            best[some], names[some] = np.inf, np.iinfo(np.int64).max
            best[r[kept], place[kept]], names[r[kept], place[kept]] = measured[kept], ids[kept]
        r, c = np.nonzero(np.isfinite(best))
        out.append((r + rows.start, names[r, c], best[r, c]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nan_euclid(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance over the coordinates both rows have, scaled up to all coordinates; infinite without a common one."""
    total, common = np.zeros((len(a), len(b))), np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        both = ~np.isnan(gap)
        total += np.where(both, gap, 0.0) ** 2
        common += both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(common > 0, np.sqrt(total * a.shape[1] / common), np.inf)


def haversine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Great-circle angle in radians between (lat, lon) rows given in radians."""
    lat = np.sin((b[None, :, 0] - a[:, 0, None]) / 2) ** 2
    lon = np.sin((b[None, :, 1] - a[:, 1, None]) / 2) ** 2
    return 2 * np.arcsin(np.sqrt(lat + np.cos(a[:, 0, None]) * np.cos(b[None, :, 0]) * lon))


METRICS = {"euclid": (euclid, 9), "haversine": (haversine, 12), "nan_euclid": (nan_euclid, 9)}


def chunks(n: int, width: int):
    step = max(1, CELLS // max(1, width))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))


def smallest(d: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` smallest finite entries per row, ties by id."""
    k = min(k, d.shape[1])
    edge = np.partition(d, k - 1, axis=1)[:, k - 1]
    rows, cols = np.nonzero((d <= edge[:, None]) & np.isfinite(d))
    order = np.lexsort((ids[cols], d[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(d.shape[0]))
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep]


def nearest_in_cells(a: np.ndarray, targets: pd.DataFrame, sources: pd.DataFrame, b: np.ndarray, k: int, places: int, skip_self: bool, stretch: float = 1.0):
    """(rows, ids, distances, distances computed) of the k nearest: source cells in order of their least distance, until none can matter.

    ``stretch`` multiplies squared distances.
    """
    tid, sid = targets.id.to_numpy(), sources.id.to_numpy()
    mine, theirs = Cells(a), cells_of(sources, b)
    out, pairs = [], 0
    for cell in range(len(mine)):
        rows = mine.rows(cell)
        least = theirs.least(mine.low[cell], mine.high[cell]) * np.sqrt(stretch)
        order = np.argsort(least, kind="stable")
        d, ids = np.full((len(rows), k), np.inf), np.full((len(rows), k), np.iinfo(np.int64).max)
        for at in range(0, len(order), 4):
            some = order[at : at + 4]
            limit = d[:, k - 1]
            if least[some[0]] > limit.max():
                break
            others = theirs.rows_of(some[least[some] <= limit.max()])
            near = np.round(euclid(a[rows], b[others], stretch), places)
            pairs += near.size
            if skip_self:
                near[tid[rows][:, None] == sid[others][None, :]] = np.inf
            if near.shape[1] > k:
                limit = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1])
            r, c = np.nonzero((near <= limit[:, None]) & np.isfinite(near))
            if not len(r):
                continue
            changed = np.unique(r)
            held = np.isfinite(d[changed])
            distance, names = np.concatenate([near[r, c], d[changed][held]]), np.concatenate([sid[others[c]], ids[changed][held]])
            r = np.concatenate([r, np.repeat(changed, held.sum(axis=1))])
            best = np.lexsort((names, distance, r))
            r, distance, names = r[best], distance[best], names[best]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            first = place < k
            d[changed], ids[changed] = np.inf, np.iinfo(np.int64).max
            d[r[first], place[first]], ids[r[first], place[first]] = distance[first], names[first]
        r, c = np.nonzero(np.isfinite(d))
        out.append((rows[r], ids[r, c], d[r, c]))
    return *(np.concatenate(x) for x in zip(*out)), pairs


def nearest_kernel(k: int, metric: str, skip_self: bool):
    measure, places = METRICS[metric]

    def run(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        a, b = matrix(targets.features), points_of(sources)
        tid, sid = targets.id.to_numpy(), sources.id.to_numpy()
        if metric == "euclid" and a.shape[1] >= WIDE and len(b) and len(a):
            rows, others, distance = nearest_by_products(a, tid, b, sid, k, places, skip_self)
            return pd.DataFrame({"id": tid[rows], "other": others, "distance": distance})
        if metric == "euclid" and len(b) > 4 * LEAF and len(a):
            rows, others, distance, _ = nearest_in_cells(a, targets, sources, b, k, places, skip_self)
            return pd.DataFrame({"id": tid[rows], "other": others, "distance": distance})
        out = []
        for part in chunks(len(a), len(b)):
            d = np.round(measure(a[part], b), places)
            if skip_self:
                d[tid[part][:, None] == sid[None, :]] = np.inf
            rows, cols = smallest(d, sid, k)
            out.append(pd.DataFrame({"id": tid[part][rows], "other": sid[cols], "distance": d[rows, cols]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "other": [], "distance": []})

    return run


#: Up to this many coordinates a search is split by which of them are missing.
PATTERN_WIDTH = 6


def donors_kernel(k: int):
    """For each missing coordinate of a target the ``k`` nearest sources that have it; a source stands for all ids in ``copies``.

    Which coordinates a target has, and which of them a source has, makes every distance an ordinary one in those they
    share, so each such pair of patterns is searched by cells.
    """

    def run(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        a, b = matrix(targets.features), matrix(sources.features)
        searched = b.shape[1] <= PATTERN_WIDTH and not np.isinf(a).any() and not np.isinf(b).any()
        found = list((_donors_by_pattern if searched else _donors_by_force)(a, b, sources, k))
        copies = [np.asarray(c, dtype=np.int64) for c in sources.copies]
        size, ids = np.array([len(c) for c in copies]), np.concatenate(copies)
        start = np.cumsum(size) - size
        out = []
        for j in range(b.shape[1]):
            parts = [(r, o, d) for at, r, o, d in found if at == j]
            if not parts:
                continue
            rows, others, distance = (np.concatenate(x) for x in zip(*parts))
            n = size[others]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            name = ids[np.repeat(start[others], n) + inside]
            rows, others, distance = (np.repeat(x, n) for x in (rows, others, distance))
            order = np.lexsort((name, distance, rows))
            kept = order[np.arange(len(order)) - np.searchsorted(rows[order], rows[order]) < k]
            out.append(pd.DataFrame({
                "id": targets.id.to_numpy()[rows[kept]], "position": np.int32(j), "other": name[kept],
                "value": b[others[kept], j], "distance": distance[kept],
            }))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "position": [], "other": [], "value": [], "distance": []})

    return run


def _donors_by_force(a: np.ndarray, b: np.ndarray, sources: pd.DataFrame, k: int):
    sid = sources.id.to_numpy()
    for part in chunks(len(a), len(b)):
        d = np.round(nan_euclid(a[part], b), 9)
        for j in range(b.shape[1]):
            lacking, having = np.flatnonzero(np.isnan(a[part][:, j])), np.flatnonzero(~np.isnan(b[:, j]))
            if len(lacking) and len(having):
                sub = d[np.ix_(lacking, having)]
                rows, cols = smallest(sub, sid[having], k)
                yield j, lacking[rows] + part.start, having[cols], sub[rows, cols]


def _donors_by_pattern(a: np.ndarray, b: np.ndarray, sources: pd.DataFrame, k: int):
    width = b.shape[1]
    bits = 1 << np.arange(width)
    has_a, has_b = (~np.isnan(a) @ bits).astype(int), (~np.isnan(b) @ bits).astype(int)
    if "donors" not in sources.attrs:
        sources.attrs["donors"] = {}
    held = sources.attrs["donors"]
    for pattern in np.unique(has_a):
        rows = np.flatnonzero(has_a == pattern)
        for j in np.flatnonzero(~pattern & bits):
            for shared in np.unique(has_b[(has_b & bits[j]) > 0] & pattern):
                if not shared:
                    continue
                columns = np.flatnonzero(shared & bits)
                key = (int(pattern), int(j), int(shared))
                if key not in held:
                    others = np.flatnonzero(((has_b & bits[j]) > 0) & ((has_b & pattern) == shared))
                    others = others[np.argsort(sources.id.to_numpy()[others], kind="stable")]
                    # of the sources at one place only the first can be among the nearest
                    _, place = np.unique(b[np.ix_(others, columns)], axis=0, return_inverse=True)
                    order = np.argsort(place.ravel(), kind="stable")
                    ordered = place.ravel()[order]
                    others = others[np.sort(order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k])]
                    held[key] = others, pd.DataFrame({"id": np.arange(len(others))}), b[np.ix_(others, columns)]
                others, numbers, points = held[key]
                mine = a[np.ix_(rows, columns)]
                found = nearest_in_cells(mine, pd.DataFrame({"id": rows}), numbers, points, k, 9, False, width / len(columns))
                yield j, rows[found[0]], others[found[1]], found[2]


def label_sums_kernel(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sum of distances and number of sources per (target, setting, source label); ``labels`` holds a label per setting."""
    ids, out = targets.id.to_numpy(), []
    for rows, s, names, counts, sums in _label_sums(targets, sources):
        size = rows.stop - rows.start
        out.append(pd.DataFrame({
            "id": np.repeat(ids[rows], len(names)), "setting": np.int32(s), "other_label": np.tile(names, size),
            "total": sums.ravel(), "n": np.tile(counts, size),
        }))
    return pd.concat(out) if out else pd.DataFrame({"id": [], "setting": [], "other_label": [], "total": [], "n": []})


def own_and_next_kernel(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """What a silhouette needs when ``sources`` are all rows: per target and setting the size of its own cluster, the mean
    distance to the others of it, and the least mean distance to another cluster."""
    ids, out = targets.id.to_numpy(), []
    given = np.array(targets.labels.tolist(), dtype=np.int64)
    for rows, s, names, counts, sums in _label_sums(targets, sources):
        own = given[rows, s]
        inside = np.flatnonzero(own != -1)
        if len(names) < 2 or not len(inside):
            continue
        at = np.searchsorted(names, own[inside])
        size, total = counts[at], sums[inside, at]
        means = sums[inside] / counts
        means[np.arange(len(inside)), at] = np.nan
        out.append(pd.DataFrame({
            "id": ids[rows][inside], "setting": np.int32(s), "label": own[inside], "size": size,
            "a": np.where(size > 1, total / np.maximum(size - 1, 1), np.nan), "b": np.fmin.reduce(means, axis=1),
        }))
    return pd.concat(out) if out else pd.DataFrame({"id": [], "setting": [], "label": [], "size": [], "a": [], "b": []})


def _label_plans(given: np.ndarray):
    """What sums per label need of the sources: (few, ends, member, many, ordered)."""
    plans = []
    for s in range(given.shape[1]):
        found, place, n = np.unique(given[:, s], return_inverse=True, return_counts=True)
        kept = np.flatnonzero(found != -1)
        if len(kept):
            plans.append((s, found[kept], n[kept], place, kept))
    if not plans:
        return None
    most = min(32, 4 * CELLS // max(1, len(given)) // len(plans))
    few, many = [p for p in plans if len(p[4]) <= most], [p for p in plans if len(p[4]) > most]
    ends = np.cumsum([0, *[len(p[4]) for p in few]])
    member = np.zeros((len(given), ends[-1]))
    for at, (_, _, _, place, kept) in zip(ends, few):
        for i, label in enumerate(kept):
            member[place == label, at + i] = 1.0
    ordered = []  # per setting and piece of the sources: those in a cluster by label, where a label starts, the labels
    for _, names, _, place, kept in many:
        number = np.full(place.max() + 1, -1)
        number[kept] = np.arange(len(kept))
        parts = []
        for cols in pieces(len(given), WIDE_COLUMNS):
            label = number[place[cols]]
            order = np.argsort(label, kind="stable")
            order = order[label[order] >= 0]
            starts = np.flatnonzero(np.append(True, label[order][1:] != label[order][:-1])) if len(order) else order
            parts.append((order, starts, label[order][starts]))
        ordered.append(parts)
    return few, ends, member, many, ordered


def _label_sums(targets: pd.DataFrame, sources: pd.DataFrame):
    """(rows, setting, labels, counts, sums): few clusters by one more product, many by runs of sources in the order of their
    label. What depends on the sources alone is worked out once per worker."""
    given = kept(sources, "given", lambda: np.array(sources.labels.tolist(), dtype=np.int64))
    plans = kept(sources, "plans", lambda: _label_plans(given))
    if plans is None:
        return
    few, ends, member, many, ordered = plans
    products = Products(matrix(targets.features), points_of(sources))
    step = max(16, min(WIDE_ROWS, 2 * CELLS // max(1, sum(len(p[4]) for p in many))))
    for rows in pieces(len(targets), step):
        size = rows.stop - rows.start
        sums = np.zeros((size, member.shape[1]))
        runs = [np.zeros((size, len(p[4]))) for p in many]
        for number, cols in enumerate(pieces(len(given), WIDE_COLUMNS)):
            d = products.roots(rows, cols)
            sums += d @ member[cols]
            for total, parts in zip(runs, ordered):
                order, starts, label = parts[number]
                if len(order):
                    total[:, label] += np.add.reduceat(d[:, order], starts, axis=1)
        for at, (s, names, n, _, labels) in zip(ends, few):
            yield rows, s, names, n, sums[:, at : at + len(labels)]
        for (s, names, n, _, _), total in zip(many, runs):
            yield rows, s, names, n, total


def by_atom(points: np.ndarray, atom: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, ...]:
    """(points in the order of their atom, where an atom starts, the labels of every atom)."""
    order = np.argsort(atom, kind="stable")
    return points[order], np.searchsorted(atom[order], np.arange(len(labels) + 1)), labels


def _atom_plans(start: np.ndarray, labels: np.ndarray):
    """Per setting (number, names, sizes, atoms in a cluster by label, where a label starts); per piece of the points (atoms,
    where they start)."""
    size, plans = np.diff(start), []
    for s in range(labels.shape[1]):
        order = np.argsort(labels[:, s], kind="stable")
        order = order[labels[order, s] != -1]
        if len(order):
            names, first = np.unique(labels[order, s], return_index=True)
            plans.append((s, names, np.add.reduceat(size[order], first), order, first))
    runs = []
    for cols in pieces(int(start[-1]), WIDE_COLUMNS):
        a, b = np.searchsorted(start, cols.start, side="right") - 1, np.searchsorted(start, cols.stop)
        runs.append((slice(a, b), np.maximum(start[a:b], cols.start) - cols.start))
    return plans, runs


def own_and_next_by_atom(targets: pd.DataFrame, sources: tuple[np.ndarray, ...]) -> pd.DataFrame:
    """``own_and_next_kernel`` with distances summed per atom; targets name theirs."""
    b, start, labels = sources
    plans, runs = _atom_plans(start, labels)
    ids, given, out = targets.id.to_numpy(), labels[targets.atom.to_numpy()], []
    products = Products(matrix(targets.features), b)
    for rows in pieces(len(targets), max(8, min(WIDE_ROWS, 2 * CELLS // max(1, len(labels))))):
        sums = np.zeros((rows.stop - rows.start, len(labels)))
        for (atoms, first), cols in zip(runs, pieces(len(b), WIDE_COLUMNS)):
            sums[:, atoms] += np.add.reduceat(products.roots(rows, cols), first, axis=1)
        for s, names, counts, order, first in plans:
            own = given[rows, s]
            inside = np.flatnonzero(own != -1)
            if len(names) < 2 or not len(inside):
                continue
            total = np.add.reduceat(sums[np.ix_(inside, order)], first, axis=1)
            at, row = np.searchsorted(names, own[inside]), np.arange(len(inside))
            size, mine, means = counts[at], total[row, at], total / counts
            means[row, at] = np.nan
            out.append(pd.DataFrame({
                "id": ids[rows][inside], "setting": np.int32(s), "label": own[inside], "size": size,
                "a": np.where(size > 1, mine / np.maximum(size - 1, 1), np.nan), "b": np.fmin.reduce(means, axis=1),
            }))
    return pd.concat(out) if out else pd.DataFrame({"id": [], "setting": [], "label": [], "size": [], "a": [], "b": []})


def degree_kernel(radii: list[float], enough: list[int] | None = None):
    """Weight of the sources within each radius of a target, the target's own included. Cells that lie wholly within the
    smallest radius count as a whole, cells beyond the largest not at all. With ``enough``, a number per radius, counting may
    end once all targets of a cell have as much, so a degree is right where it is less."""

    def run(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        a, b, weight = matrix(targets.features), points_of(sources), sources.weight.to_numpy(dtype=float)
        if a.shape[1] >= WIDE and len(a):
            products, degree = Products(a, b), np.zeros((len(a), len(radii)))
            for rows in pieces(len(a), WIDE_ROWS):
                for cols in pieces(len(b), WIDE_COLUMNS):
                    for i, near in enumerate(products.within(rows, cols, radii)):
                        degree[rows, i] += near @ weight[cols]
            return pd.DataFrame({"id": targets.id.to_numpy(), "degree": list(degree)})
        mine, theirs = Cells(a), cells_of(sources, b)
        held = np.add.reduceat(weight[theirs.order], theirs.start[:-1])
        # settings that share a radius are counted together, until the last of them has enough
        steps, step = np.unique(radii, return_inverse=True)
        wanted = np.full(len(steps), np.inf if enough is None else 0.0)
        if enough is not None:
            np.maximum.at(wanted, step, enough)
        counted = np.zeros((len(a), len(steps)))
        for cell in range(len(mine)):
            rows = mine.rows(cell)
            whole = theirs.greatest(mine.low[cell], mine.high[cell]) <= steps[0]
            counted[rows] += held[whole].sum()
            least = theirs.least(mine.low[cell], mine.high[cell])
            partly = np.flatnonzero(~whole & (least <= steps[-1]))
            partly = partly[np.argsort(least[partly], kind="stable")]
            for at in range(0, len(partly), 16):
                reached = steps >= least[partly[at]]  # what is left is too far for the others
                rows = rows[(counted[rows][:, reached] < wanted[reached]).any(axis=1)]
                if not len(rows):
                    break
                others = theirs.rows_of(partly[at : at + 16])
                d = euclid(a[rows], b[others])
                for i in np.flatnonzero(reached):
                    counted[rows, i] += (d <= steps[i]) @ weight[others]
        degree = counted[:, step]
        return pd.DataFrame({"id": targets.id.to_numpy(), "degree": list(degree)})

    return run


class Unions:
    """Components of names 0, 1, ...; ``root`` holds the component of every name, ``links`` the pairs that united some."""

    def __init__(self, size: int):
        self.root, self.links = np.arange(size), []

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = sorted((self.root[x], self.root[y]))
            if x != y:
                self.links.append((x, y))
                self.root[self.root == y] = x


def unite_near(a: np.ndarray, b: np.ndarray, mine: Cells, theirs: Cells, name_a: np.ndarray, name_b: np.ndarray, size: int, radius: float) -> Unions:
    """Unites the names (-1: none) of points no farther apart than ``radius``. Points that are united already are not compared."""
    unions = Unions(size)
    ordered = name_b[theirs.order]
    for cell in range(len(mine)):
        rows = mine.rows(cell)
        rows = rows[name_a[rows] >= 0]
        if not len(rows):
            continue
        least = theirs.least(mine.low[cell], mine.high[cell])
        near = np.flatnonzero(least <= radius)
        near = near[np.argsort(least[near], kind="stable")]
        whole = theirs.greatest(mine.low[cell], mine.high[cell]) <= radius
        for at in range(0, len(near), 16):
            some = near[at : at + 16]
            own = np.unique(unions.root[name_a[rows]])
            others = theirs.rows_of(some)
            full = np.repeat(whole[some], theirs.start[some + 1] - theirs.start[some])
            names = np.concatenate([ordered[theirs.start[c] : theirs.start[c + 1]] for c in some])
            asked = names >= 0
            if len(own) == 1:
                asked[asked] = unions.root[names[asked]] != own[0]
            if full[asked].any():  # everything in these is within reach of every row
                found = np.unique(unions.root[np.concatenate([own, names[full & asked]])])
                unions.unite(np.repeat(found[:1], len(found) - 1), found[1:])
            others, names = others[asked & ~full], names[asked & ~full]
            if not len(others):
                continue
            r, c = np.nonzero(euclid(a[rows], b[others]) <= radius)
            x, y = unions.root[name_a[rows[r]]], unions.root[names[c]]
            pairs = np.unique(np.minimum(x, y)[x != y] * size + np.maximum(x, y)[x != y])
            unions.unite(pairs // size, pairs % size)
    return unions


def local_components(radii: list[float]):
    """(id, labels) of batches: per radius the smallest label among the points that chains of steps within it join in a batch."""

    def joined(targets: pd.DataFrame) -> pd.DataFrame:
        a, labels = matrix(targets.features), matrix(targets.labels)
        cells = Cells(a)
        for i, radius in enumerate(radii):
            names, place = np.unique(labels[:, i][~np.isnan(labels[:, i])], return_inverse=True)
            name = np.full(len(a), -1)
            name[~np.isnan(labels[:, i])] = place
            if len(names):
                united = unite_near(a, a, cells, cells, name, name, len(names), radius)
                labels[name >= 0, i] = names[united.root[name[name >= 0]]]
        return pd.DataFrame({"id": targets.id.to_numpy(), "labels": list(labels)})

    def run(batches):
        for batch in batches:
            if len(batch):
                yield joined(batch)

    return run


def links_kernel(radii: list[float]):
    """(s, a, b): per radius which labels points within it have; only pairs that unite what others of the task have not."""

    def run(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        a, b = matrix(targets.features), points_of(sources)
        mine, theirs = Cells(a), cells_of(sources, b)
        given, held = matrix(targets.labels), kept(sources, "labels", lambda: matrix(sources.labels))
        out = [pd.DataFrame({"s": [], "a": [], "b": []})]
        for i, radius in enumerate(radii):
            every = np.concatenate([given[:, i], held[:, i]])
            names, place = np.unique(every[~np.isnan(every)], return_inverse=True)
            name = np.full(len(every), -1)
            name[~np.isnan(every)] = place
            links = unite_near(a, b, mine, theirs, name[: len(a)], name[len(a) :], len(names), radius).links if len(names) else []
            if links:
                x, y = np.array(links).T
                out.append(pd.DataFrame({"s": i, "a": names[x], "b": names[y]}))
        return pd.concat(out).astype({"s": "int32", "a": "int64", "b": "int64"})

    return run


def least_label_kernel(radii: list[float], passes: int = 4):
    """Per radius the smallest label a target can reach: directly from the sources within it, and onwards through other
    labelled targets of the same block, so that a chain inside a block is walked in one call. NaN when there is none."""

    def run(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        a, b, labels = matrix(targets.features), points_of(sources), matrix(sources.labels)
        labels = np.where(np.isnan(labels), np.inf, labels)
        if a.shape[1] >= WIDE and len(a):
            return pd.DataFrame({"id": targets.id.to_numpy(), "least": list(_least_by_products(a, b, labels, radii))})
        order = np.argsort(sources.id.to_numpy())
        place = np.clip(np.searchsorted(sources.id.to_numpy()[order], targets.id.to_numpy()), 0, len(b) - 1)
        place = order[place]
        known = sources.id.to_numpy()[place] == targets.id.to_numpy()
        mine, theirs = Cells(a), cells_of(sources, b)
        wholes, partly = [], []
        for cell in range(len(mine)):
            wholes.append(theirs.greatest(mine.low[cell], mine.high[cell]) <= min(radii))
            partly.append(theirs.rows_of(np.flatnonzero(~wholes[-1] & (theirs.least(mine.low[cell], mine.high[cell]) <= max(radii)))))
        work = sum(len(mine.rows(c)) * len(partly[c]) for c in range(len(mine)))
        kept: dict[int, list[np.ndarray]] = {}
        reach = np.full((len(a), len(radii)), np.inf)
        for _ in range(1_000_000 if work <= 4 * CELLS else passes):
            before = labels.copy()
            least = np.minimum.reduceat(labels[theirs.order], theirs.start[:-1], axis=0)
            for cell in range(len(mine)):
                rows, others = mine.rows(cell), partly[cell]
                if wholes[cell].any():
                    reach[rows] = np.minimum(reach[rows], least[wholes[cell]].min(axis=0))
                if len(others):
                    near = kept.get(cell)
                    if near is None:
                        d = euclid(a[rows], b[others])
                        near = [d <= r for r in radii]
                        if work <= 4 * CELLS:
                            kept[cell] = near
                    for i in range(len(radii)):
                        reach[rows, i] = np.minimum(reach[rows, i], np.where(near[i], labels[others][None, :, i], np.inf).min(axis=1))
            at, found = place[known], reach[known]
            labels[at] = np.where(np.isinf(labels[at]), np.inf, np.minimum(labels[at], found))
            if np.array_equal(before, labels):
                break
        return pd.DataFrame({"id": targets.id.to_numpy(), "least": list(np.where(np.isinf(reach), np.nan, reach))})

    return run


def _least_by_products(a: np.ndarray, b: np.ndarray, labels: np.ndarray, radii: list[float]) -> np.ndarray:
    reach = np.full((len(a), len(radii)), np.inf)
    for i, radius in enumerate(radii):
        core = np.flatnonzero(np.isfinite(labels[:, i]))
        if not len(core):
            continue
        core = core[np.argsort(labels[core, i], kind="stable")]
        products, label = Products(a, b[core]), labels[core, i]
        for rows in pieces(len(a), WIDE_ROWS):
            for cols in pieces(len(core), WIDE_COLUMNS):  # in the order of their labels: the first one within reach is the least
                if np.isfinite(reach[rows, i]).all():
                    break
                near = products.within(rows, cols, [radius])[0]
                first = np.where(near.any(axis=1), label[cols][near.argmax(axis=1)], np.inf)
                reach[rows, i] = np.minimum(reach[rows, i], first)
    return np.where(np.isinf(reach), np.nan, reach)


def outgoing_edges_kernel(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Per tree and component the lightest mutual-reachability edge to another component, ties by the ordered pair of ids."""
    points = [matrix(targets.features), points_of(sources)]
    sides = [
        {"id": side.id.to_numpy(), "core": matrix(side.cores), "component": np.array(side.components.tolist(), dtype=np.int64)} for side in (targets, sources)
    ]
    search = LightestEdges(lambda x, y: np.round(euclid(x, y), 9))
    found = search.find(*sides, Cells(points[0]), cells_of(sources, points[1]))
    return pd.concat([
        pd.DataFrame({"tree": np.int32(t), "component": c, "weight": w, "low": low, "high": high, "to_component": to}) for t, (c, w, low, high, to) in enumerate(found)
    ])


def worst_ratio_kernel(targets: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Largest (spread_i + spread_j) / distance_ij over the other centroids of the same setting."""
    a, b = matrix(targets.features), points_of(sources)
    mine, theirs, worst = targets.setting.to_numpy(), sources.setting.to_numpy(), np.full(len(targets), -np.inf)
    spread, others_spread, ids, others_ids = targets.spread.to_numpy(), sources.spread.to_numpy(), targets.id.to_numpy(), sources.id.to_numpy()
    for setting in np.unique(mine):
        every, others = np.flatnonzero(mine == setting), np.flatnonzero(theirs == setting)
        for part in chunks(len(every), len(others)):
            rows = every[part]
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = (spread[rows][:, None] + others_spread[others][None, :]) / euclid(a[rows], b[others])
            ratio[ids[rows][:, None] == others_ids[others][None, :]] = -np.inf
            if len(others):
                worst[rows] = ratio.max(axis=1)
    return pd.DataFrame({"setting": mine, "id": ids, "worst": worst})


def lloyd_sums(x: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per centre the weighted sums of the coordinates, of the weights and of the squared distances of the rows nearest to it."""
    k, width = centres.shape
    out = np.zeros((k, width + 2))
    for rows in pieces(len(x), 16_384):
        columns, weight = np.ascontiguousarray(x[rows].T), w[rows]
        d = np.zeros((k, len(weight)))
        for i, c in enumerate(centres):
            for j in range(width):
                d[i] += (columns[j] - c[j]) ** 2
        near = d.argmin(axis=0)
        for j, values in enumerate([*(columns * weight), weight, d[near, np.arange(len(near))] * weight]):
            out[:, j] += np.bincount(near, values, minlength=k)
    return out


def moved_centres(total: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, float]:
    """Means of the rows nearest to every centre, and the farthest that one moved."""
    n, width = total[:, -2:-1], centres.shape[1]
    moved = np.where(n > 0, total[:, :width] / np.where(n > 0, n, 1.0), centres)
    return moved, np.sqrt(((moved - centres) ** 2).sum(axis=1)).max()


def settled(x: np.ndarray, w: np.ndarray, centres: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """Centres and cost of one start that sees all rows."""
    for turn in range(max_iter + 1):
        total = lloyd_sums(x, w, centres)
        moved, shift = moved_centres(total, centres)
        if not (shift > tol and turn < max_iter):
            break
        centres = moved
    return centres, float(total[:, -1].sum())


def solve_moments(batches, keys: list[str], width: int):
    """Least-squares coefficients from summed products, one row per series in and out."""
    for batch in batches:
        out = {k: batch[k] for k in keys}
        betas, sses = [], []
        upper = np.triu_indices(width)
        for products, cross, yy in zip(batch["xtx"], batch["xty"], batch["yy"]):
            gram = np.zeros((width, width))
            gram[upper] = products
            gram = gram + np.triu(gram, 1).T
            right = np.asarray(cross, dtype=float)
            beta = np.linalg.lstsq(gram, right, rcond=1e-12)[0]
            betas.append(beta)
            sses.append(max(0.0, float(yy - 2 * beta @ right + beta @ gram @ beta)))
        yield pd.DataFrame(out | {"beta": betas, "n": batch["n"], "sse": sses})


def _history(column, depth: int) -> np.ndarray:
    """Last ``depth`` values of every row's list, the newest on the right, NaN where a list is shorter."""
    lists = [np.asarray(v, dtype=float) for v in column]
    size = np.minimum([len(v) for v in lists], depth)
    out = np.full((len(lists), depth), np.nan)
    rows = np.repeat(np.arange(len(lists)), size)
    back = np.concatenate([np.arange(n, 0, -1) for n in size]) if len(lists) else np.zeros(0, int)
    out[rows, depth - back] = np.concatenate([v[len(v) - n :] for v, n in zip(lists, size)]) if len(lists) else 0.0
    return out


def stationary(beta: np.ndarray, ar: list[int], radius: float = 0.999) -> np.ndarray:
    """Coefficients whose recursion would grow without bound (a root outside the unit circle) are shrunk, lag k by the k-th
    power of one factor per series, so that the largest root has ``radius``; the others stay."""
    if not ar or not len(beta):
        return beta
    depth = max(ar)
    companion = np.zeros((len(beta), depth, depth))
    companion[:, np.arange(1, depth), np.arange(depth - 1)] = 1.0
    for i, k in enumerate(ar):
        companion[:, 0, k - 1] = np.nan_to_num(beta[:, 1 + i])
    largest = np.abs(np.linalg.eigvals(companion)).max(axis=1)
    factor = np.where(largest > 1 + 1e-9, radius / np.maximum(largest, 1.0), 1.0)
    out = beta.copy()
    for i, k in enumerate(ar):
        out[:, 1 + i] *= factor**k
    return out


def roll_forward(batches, keys: list[str], ar: list[int], ma: list[int], weights: dict[int, float], steps: int):
    """Recursive forecast of all series of a batch at once: a vector over the series per step, differenced values ahead and then
    back to the original scale. Lags before the start of a series count as 0; without the values that differencing needs the
    forecast is null."""
    depth = max([*ar, *ma, *weights, 1])
    back = {k: c for k, c in weights.items() if k > 0}
    for batch in batches:
        n = len(batch)
        if not n or not steps:
            continue
        w, e, y = (np.concatenate([_history(batch[c], depth), np.zeros((n, steps))], axis=1) for c in ("w_tail", "e_tail", "y_tail"))
        w[:, :depth], e[:, :depth] = np.nan_to_num(w[:, :depth]), np.nan_to_num(e[:, :depth])
        beta = stationary(np.array(batch["beta"].tolist(), dtype=float), ar)
        for at in range(depth, depth + steps):
            value = beta[:, 0].copy()
            for i, k in enumerate(ar):
                value += beta[:, 1 + i] * w[:, at - k]
            for i, k in enumerate(ma):
                value += beta[:, 1 + len(ar) + i] * e[:, at - k]
            w[:, at] = value
            y[:, at] = value - sum(c * y[:, at - k] for k, c in back.items())
        ahead = y[:, depth:].ravel()
        out = {k: np.repeat(batch[k].to_numpy(), steps) for k in keys}
        yield pd.DataFrame(out | {"step": np.tile(np.arange(1, steps + 1, dtype=np.int32), n), "forecast": pd.array(np.where(np.isnan(ahead), 0.0, ahead), dtype="Float64").copy()}).assign(
            forecast=lambda d: d["forecast"].mask(np.isnan(ahead))
        )

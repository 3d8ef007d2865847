"""Boxes around groups of near points, with which a task skips pairs of groups that cannot matter.

Points are halved at the median of their widest coordinate until a cell holds at most ``LEAF`` of them. Two boxes have a
least and a greatest distance, so a search that knows what it still needs compares points only for cells in between.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 64
#: Distances are rounded by the kernels; a bound gives way by as much.
ROUNDING = 2e-9


class Cells:
    """``order`` lists the points cell by cell; cell c holds ``order[start[c] : start[c + 1]]`` inside ``low[c]``..``high[c]``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        bounds, pending = [0], [(0, len(points))]
        while pending:
            a, b = pending.pop()
            part = points[order[a:b]]
            spread = part.max(axis=0) - part.min(axis=0) if b - a > leaf else np.zeros(1)
            if not spread.size or not spread.max() > 0:
                if b > a:
                    bounds.append(b)
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, int(spread.argmax())], middle)]
            pending += [(a + middle, b), (a, a + middle)]  # the left part is finished first
        self.points, self.order, self.start = points, order, np.array(bounds)
        at = self.start[:-1]
        self.low = np.minimum.reduceat(points[order], at, axis=0) if len(points) else points
        self.high = np.maximum.reduceat(points[order], at, axis=0) if len(points) else points

    def __len__(self) -> int:
        return len(self.start) - 1

    def rows(self, cell: int) -> np.ndarray:
        return self.order[self.start[cell] : self.start[cell + 1]]

    def rows_of(self, cells: np.ndarray) -> np.ndarray:
        return np.concatenate([self.rows(c) for c in cells]) if len(cells) else np.zeros(0, np.int64)

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least distance of every cell to a box."""
        gap = np.maximum(np.maximum(self.low - high, low - self.high), 0.0)
        return np.sqrt((gap * gap).sum(axis=1)) - ROUNDING

    def greatest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        gap = np.maximum(self.high - low, high - self.low)
        return np.sqrt((gap * gap).sum(axis=1)) + ROUNDING

    def smallest(self, values: np.ndarray) -> np.ndarray:
        """Per cell the smallest value of its points."""
        return np.minimum.reduceat(values[self.order], self.start[:-1])

    def largest(self, values: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(values[self.order], self.start[:-1])


class Kept(dict):
    """What calls in one worker share about a table; pandas copies ``attrs`` with every column it hands out, this stays one."""

    def __deepcopy__(self, memo: dict) -> Kept:
        return self


def kept(frame, name: str, make):
    """``make()``, once per table."""
    held = frame.attrs.setdefault("kept", Kept())
    if name not in held:
        held[name] = make()
    return held[name]


def cells_of(frame, points: np.ndarray) -> Cells:
    """Cells of a table that several calls in one worker share, built once."""
    return kept(frame, "cells", lambda: Cells(points))


def halvings(sample: np.ndarray, depth: int) -> list[tuple[int, float] | None]:
    """Cuts (coordinate, value) of the places of a sample, each at the median of the widest coordinate; the parts of cut i are
    cuts 2i + 1 and 2i + 2. None where all points are equal."""
    cuts: list[tuple[int, float] | None] = []
    parts = [sample]
    for _ in range(depth):
        halves = []
        for part in parts:
            spread = part.max(axis=0) - part.min(axis=0) if len(part) > 1 else np.zeros(1)
            j = int(spread.argmax())
            if not spread[j] > 0:
                cuts.append(None)
                halves += [part, part[:0]]
                continue
            middle = float(np.sort(part[:, j])[len(part) // 2])
            cuts.append((j, middle))
            left = part[:, j] < middle
            halves += [part[left], part[~left]]
        parts = halves
    return cuts


class LightestEdges:
    """Lightest outgoing edge per component under mutual reachability, for several core distances at once.

    ``pairs`` counts the distances computed.
    """

    def __init__(self, distance):
        self.distance, self.pairs = distance, 0

    def find(self, a: dict, b: dict, targets: Cells, sources: Cells) -> list[tuple[np.ndarray, ...]]:
        """Per tree (component, weight, low, high, to_component). ``a`` and ``b`` hold id (n), core and component (n, trees)."""
        trees = a["core"].shape[1]
        index, best = [], []
        for t in range(trees):
            names, place = np.unique(a["component"][:, t], return_inverse=True)
            index.append((names, place))
            best.append((np.full(len(names), np.inf), np.zeros((len(names), 3), np.int64)))
        cell_core = [sources.smallest(b["core"][:, t]) for t in range(trees)]
        cell_low = [sources.smallest(b["component"][:, t]) for t in range(trees)]
        cell_high = [sources.largest(b["component"][:, t]) for t in range(trees)]
        for cell in range(len(targets)):
            rows = targets.rows(cell)
            least = sources.least(targets.low[cell], targets.high[cell])
            bounds = []
            for t in range(trees):
                bound = np.maximum(least, np.maximum(cell_core[t], a["core"][rows, t].min()) - ROUNDING)
                mine = a["component"][rows, t]
                if mine.min() == mine.max():  # a source cell of the same single component has nothing to offer
                    bound = np.where((cell_low[t] == mine[0]) & (cell_high[t] == mine[0]), np.inf, bound)
                bounds.append(bound)
            lowest = np.minimum.reduce(bounds)
            order = np.argsort(lowest, kind="stable")
            at = 0
            while at < len(order) and np.isfinite(lowest[order[at]]):
                need = [best[t][0][index[t][1][rows]].max() for t in range(trees)]
                some = order[at : at + 8]
                at += 8
                some = some[np.logical_or.reduce([bounds[t][some] <= need[t] for t in range(trees)])]
                if not len(some):
                    if all(lowest[order[min(at, len(order) - 1)]] > need[t] for t in range(trees)):
                        break
                    continue
                others = sources.rows_of(some)
                d = self.distance(targets.points[rows], sources.points[others])
                self.pairs += d.size
                for t in range(trees):
                    self._take(best[t], index[t][1][rows], d, a, b, rows, others, t)
        out = []
        for t in range(trees):
            found = np.isfinite(best[t][0])
            low, high, to = best[t][1][found].T
            out.append((index[t][0][found], best[t][0][found], low, high, to))
        return out

    @staticmethod
    def _take(best, place, d, a, b, rows, others, t) -> None:
        weight = np.maximum(d, np.maximum(a["core"][rows, t][:, None], b["core"][others, t][None, :]))
        weight[a["component"][rows, t][:, None] == b["component"][others, t][None, :]] = np.inf
        light = weight.min(axis=1)
        hopeful = np.isfinite(light) & (light <= best[0][place])
        r, c = np.nonzero((weight == light[:, None]) & hopeful[:, None])
        if not len(r):
            return
        x, y = a["id"][rows[r]], b["id"][others[c]]
        low, high, to = np.minimum(x, y), np.maximum(x, y), b["component"][others[c], t]
        order = np.lexsort((high, low, light[r], place[r]))
        first = order[np.unique(place[r][order], return_index=True)[1]]
        for k in first:
            p, edge = place[r[k]], (low[k], high[k], to[k])
            w = light[r[k]]
            if w < best[0][p] or (w == best[0][p] and edge[:2] < tuple(best[1][p][:2])):
                best[0][p] = w
                best[1][p] = edge

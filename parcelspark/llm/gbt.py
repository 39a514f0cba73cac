"""Gradient-boosted trees with monotonic constraints, flattened for numpy scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """All trees in one set of node arrays; leaves point to themselves.

    ``x <= threshold`` (or a missing value) goes left.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(goes_right, self.right[node], self.left[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 48,
    min_weight: float = 5.0,
    l2: float = 1.0,
) -> FlatTrees:
    """Logistic loss, histogram splits.

    ``monotone[f]`` is -1 (score never rises with the feature), 0 or +1.  A
    split on a constrained feature must order its children, and both subtrees
    are bounded by the children's midpoint, so whole trees obey it.
    """
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1) if n else np.zeros((0, m), int)
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(feature)
        feature.append(0)
        threshold.append(0.0)
        left.append(k)
        right.append(k)
        value.append(rate * v)
        return k

    def grow(rows, g, h, level, lo, hi) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        node = leaf(float(np.clip(-gs / (hs + l2), lo, hi)))
        if level == depth or hs < 2 * min_weight:
            return node
        best = (1e-6, None)
        for f in range(m):
            if not len(edges[f]):
                continue
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, g[rows], len(edges[f]) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(edges[f]) + 1))[:-1]
            gr, hr = gs - gl, hs - hl
            vl, vr = np.clip(-gl / (hl + l2), lo, hi), np.clip(-gr / (hr + l2), lo, hi)
            gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - gs**2 / (hs + l2)
            gain[(hl < min_weight) | (hr < min_weight)] = 0
            if monotone[f]:
                gain[(vr - vl) * monotone[f] < 0] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1] is None:
            return node
        f, k, vl, vr = best[1]
        mid = (vl + vr) / 2
        to_left = binned[rows, f] <= k
        bounds = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}.get(int(monotone[f]), ((lo, hi), (lo, hi)))
        feature[node], threshold[node] = f, float(edges[f][k])
        left[node] = grow(rows[to_left], g, h, level + 1, *bounds[0])
        right[node] = grow(rows[~to_left], g, h, level + 1, *bounds[1])
        return node

    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        roots.append(grow(np.arange(n), g, h, 0, -4.0, 4.0))
        one = FlatTrees(*map(np.array, ([roots[-1]], feature, threshold, left, right, value)), 0.0, depth)
        margin = margin + one.margin(x)
    arrays = (np.array(a, dtype=t) for a, t in ((roots, np.int64), (feature, np.int64), (threshold, float), (left, np.int64), (right, np.int64), (value, float)))
    return FlatTrees(*arrays, base, depth)

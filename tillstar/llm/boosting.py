"""A small gradient boosting of regression trees for yes/no labels, on NumPy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Sum of trees as arrays; a node goes left where its feature is at most its cut."""

    start: float
    feature: np.ndarray  # trees x inner nodes, in heap order
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (2**depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; cuts are the midpoints between values."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    values = [np.unique(x[:, f]) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(v, x[:, f]) for f, v in enumerate(values)], axis=1)
    margin = np.full(len(x), start)
    features, cuts, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(x), int)
        feature, cut = np.zeros(2**depth - 1, int), np.full(2**depth - 1, np.inf)
        for at in range(2**depth - 1):
            inside = node == at
            if inside.any():
                feature[at], cut[at] = _split(binned[inside], g[inside], h[inside], values, ridge)
            go = x[inside, feature[at]] > cut[at]
            node[inside] = 2 * at + 1 + go
        place = node - (2**depth - 1)
        total_g, total_h = (np.bincount(place, w, 2**depth) for w in (g, h))
        leaf = -rate * total_g / (total_h + ridge)
        margin += leaf[place]
        features.append(feature), cuts.append(cut), leaves.append(leaf)
    return Trees(start, np.array(features), np.array(cuts), np.array(leaves))


def _split(binned, g, h, values, ridge) -> tuple[int, float]:
    """The feature and cut of the greatest gain; a cut of infinity where none gains."""
    best = (1e-6, 0, np.inf)
    total_g, total_h = g.sum(), h.sum()
    for f, v in enumerate(values):
        if len(v) < 2:
            continue
        left_g = np.cumsum(np.bincount(binned[:, f], g, len(v)))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, f], h, len(v)))[:-1]
        gain = (
            left_g**2 / (left_h + ridge) + (total_g - left_g) ** 2 / (total_h - left_h + ridge) - total_g**2 / (total_h + ridge)
        )
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], f, (v[k] + v[k + 1]) / 2)
    return best[1], best[2]

"""Gradient-boosted trees and isotonic calibration on small dense matrices (numpy)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: feature and threshold of each inner node, values of the leaves."""

    start: float
    features: np.ndarray  # trees x inner nodes
    bounds: np.ndarray
    leaves: np.ndarray  # trees x 2**depth

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.start)
        inner = self.features.shape[1]
        for feature, bound, leaf in zip(self.features, self.bounds, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node.max(initial=0) < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
            out += leaf[node - inner]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Boosting of the logistic loss; splits are searched on histograms of quantile bins."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    rate_of = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(rate_of / (1 - rate_of)))
    margin, inner = np.full(n, start), (1 << depth) - 1
    features, bounds, leaves = [], [], []
    for _ in range(rounds):
        p = _sigmoid(margin)
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-9)
            for j in range(width):
                steps = len(cuts[j]) + 1
                if steps < 2:
                    continue
                at = (node - first) * steps + binned[:, j]
                g = np.bincount(at, gradient, count * steps).reshape(count, steps)
                h = np.bincount(at, weight, count * steps).reshape(count, steps)
                left, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
                all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = left**2 / (left_h + ridge) + (all_g - left) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
                k = gain.argmax(1)
                found = gain[np.arange(count), k]
                for i in np.flatnonzero(found > best):
                    best[i], feature[first + i], bound[first + i] = found[i], j, cuts[j][k[i]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > bound[node])
        leaf = node - inner
        value = np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, weight, inner + 1) + ridge) * rate
        margin += value[leaf]
        features.append(feature)
        bounds.append(bound)
        leaves.append(value)
    return Trees(start, np.array(features), np.array(bounds), np.array(leaves))


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function of the margin that fits the labels best (pool adjacent violators)."""
    at, inverse = np.unique(margin, return_inverse=True)
    weights = np.bincount(inverse).astype(float)
    means = np.bincount(inverse, y) / weights
    blocks: list[list[float]] = []  # mean, weight, first knot, last knot
    for k, (mean, weight) in enumerate(zip(means, weights, strict=True)):
        blocks.append([mean, weight, at[k], at[k]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            top = blocks.pop()
            total = blocks[-1][1] + top[1]
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + top[0] * top[1]) / total, total, blocks[-1][2], top[3]]
    knots = np.array([(x, b[0]) for b in blocks for x in ((b[2], b[3]) if b[3] > b[2] else (b[2],))])
    return knots[:, 0], knots[:, 1]

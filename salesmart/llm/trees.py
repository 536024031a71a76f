"""Gradient-boosted trees of fixed depth for a yes-no label, on binned features; fitted on a bounded sample."""

from __future__ import annotations

import numpy as np

from salesmart.llm.tasks import ship


class Trees:
    """``features`` and ``limits`` hold each tree's inner nodes level by level, ``leaves`` its log-odds."""

    def __init__(self, base: float, features: np.ndarray, limits: np.ndarray, leaves: np.ndarray):
        self.base, self.features, self.limits, self.leaves = base, features, limits, leaves

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < len(features):
                at = 2 * at + 1 + (x[rows, features[at]] > limits[at])
            score += leaves[at - len(features)] if at.size else 0.0
        return 1 / (1 + np.exp(-score))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 5, bins: int = 32, rate: float = 0.3, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss; splits at bin edges, equal gains go to the earlier feature and bin."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(width)]
    codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)]).astype(np.int64)
    share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner, outer = (1 << depth) - 1, 1 << depth
    features, limits, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, outer))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, curve = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            size, first = 1 << level, (1 << level) - 1
            gain, where = np.full((width, size), 0.0), np.zeros((width, size), np.int64)
            for j in range(width):
                if not len(edges[j]):
                    continue
                key = at * bins + codes[j]
                g = np.bincount(key, gradient, size * bins).reshape(size, bins).cumsum(1)
                h = np.bincount(key, curve, size * bins).reshape(size, bins).cumsum(1)
                left, right = g[:, :-1], g[:, -1:] - g[:, :-1]
                gains = left**2 / (h[:, :-1] + ridge) + right**2 / (h[:, -1:] - h[:, :-1] + ridge) - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                gains = gains[:, : len(edges[j])]
                where[j] = gains.argmax(1)
                gain[j] = gains[np.arange(size), where[j]]
            best = gain.argmax(0)
            for node in range(size):
                j = best[node]
                if gain[j, node] > 1e-6:
                    features[t, first + node], limits[t, first + node] = j, edges[j][where[j, node]]
            split = np.where(np.isfinite(limits[t, first : first + size]), where[best, np.arange(size)], bins)
            at = 2 * at + (codes[best[at], np.arange(n)] > split[at])
        g, h = np.bincount(at, gradient, outer), np.bincount(at, curve, outer)
        leaves[t] = -rate * g / (h + ridge)
        score += leaves[t][at]
    return Trees(base, features, limits, leaves)


ship(__name__)

"""Gradient-boosted trees with monotonic constraints, flattened into numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """Complete binary trees in heap order: children of node k are 2k+1 and 2k+2.

    A row goes right if its feature is above the node's threshold; a node that
    was not split has threshold infinity, so its rows all go left.
    """

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.value.shape[1] - 1).bit_length()
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
    penalty: float = 1.0,
    least_hessian: float = 1.0,
) -> FlatTrees:
    """Fit to 0/1 labels. ``signs``: 1 or -1 where the score may only rise or fall with a feature, else 0.

    A split on a constrained feature needs its two values in the right order, and
    the middle between them bounds all values below it, so no deeper split can
    break the order.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    rate_of_ones = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    all_features = np.zeros((trees, inner), np.int64)
    all_thresholds = np.full((trees, inner), np.inf)
    all_values = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        low, high = np.full(1, -np.inf), np.full(1, np.inf)
        for level in range(depth):
            count = 2**level
            best = np.full(count, 1e-9)
            split_feature, split_bin = np.zeros(count, np.int64), np.full(count, -1)
            left_value, right_value = np.zeros(count), np.zeros(count)
            for f in range(width):
                cells = len(edges[f]) + 1
                if cells < 2:
                    continue
                at = node * cells + binned[f]
                g = np.bincount(at, gradient, count * cells).reshape(count, cells).cumsum(axis=1)
                h = np.bincount(at, hessian, count * cells).reshape(count, cells).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                g_left, h_left = g[:, :-1], h[:, :-1]
                bounds = low[:, None], high[:, None]
                left = np.clip(-g_left / (h_left + penalty), *bounds)
                right = np.clip(-(g_all - g_left) / (h_all - h_left + penalty), *bounds)
                own = np.clip(-g_all / (h_all + penalty), *bounds)

                def loss(gg, hh, v):
                    return gg * v + 0.5 * (hh + penalty) * v * v

                gain = loss(g_all, h_all, own) - loss(g_left, h_left, left) - loss(g_all - g_left, h_all - h_left, right)
                allowed = (h_left >= least_hessian) & (h_all - h_left >= least_hessian)
                if signs[f]:
                    allowed &= signs[f] * (right - left) >= 0
                gain = np.where(allowed, gain, -np.inf)
                k = gain.argmax(axis=1)
                rows = np.arange(count)
                better = gain[rows, k] > best
                best = np.where(better, gain[rows, k], best)
                split_feature[better], split_bin[better] = f, k[better]
                left_value = np.where(better, left[rows, k], left_value)
                right_value = np.where(better, right[rows, k], right_value)
            low, high = np.repeat(low, 2), np.repeat(high, 2)
            threshold_bin = np.where(split_bin >= 0, split_bin, bins + 1)
            for k in np.flatnonzero(split_bin >= 0):
                f = split_feature[k]
                all_features[t, count - 1 + k] = f
                all_thresholds[t, count - 1 + k] = edges[f][split_bin[k]]
                if signs[f]:
                    middle = (left_value[k] + right_value[k]) / 2
                    upper, lower = (2 * k, 2 * k + 1) if signs[f] < 0 else (2 * k + 1, 2 * k)
                    high[lower] = min(high[lower], middle)
                    low[upper] = max(low[upper], middle)
            node = 2 * node + (binned[split_feature[node], np.arange(n)] > threshold_bin[node])
        g = np.bincount(node, gradient, leaves)
        h = np.bincount(node, hessian, leaves)
        all_values[t] = rate * np.clip(-g / (h + penalty), low, high)
        margin += all_values[t][node]
    return FlatTrees(base, all_features, all_thresholds, all_values)

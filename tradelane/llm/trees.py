"""Gradient-boosted trees over document statistics, flat node arrays, monotonic features.

Fitted on a bounded sample in numpy; a fitted model is five small arrays, scored for whole
batches at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node i of tree t splits on feature[t, i] at threshold[t, i]; children 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3,
        rate: float = 0.15, bins: int = 64, l2: float = 5.0, least: int = 20) -> Trees:
    """Log-loss boosting with second-order gains on quantile bins.

    ``monotone``: +1 (never falls with the feature), -1 (never rises) or 0 per feature. A split
    that breaks its constraint is not made, and the middle of the two sides bounds all below it.
    With one class only, or no rows, the model is the constant of that class (no rows: 1).
    """
    n, width = x.shape
    inner, nodes = 2 ** depth - 1, 2 ** (depth + 1) - 1
    share = float(y.mean()) if n else 1.0
    share = min(max(share, 1e-4), 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, nodes)), depth, base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    features, thresholds, values = [], [], []
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(nodes)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        node = np.zeros(n, np.int64)
        for i in range(inner):
            own = np.flatnonzero(node == i)
            total_g, total_h = g[own].sum(), h[own].sum()
            value[i] = np.clip(total_g / (total_h + l2), low[i], high[i])
            best = (1e-6, None)
            for j in range(width):
                if not len(cuts[j]) or len(own) < 2 * least:
                    continue
                size = len(cuts[j]) + 1
                gl = np.cumsum(np.bincount(code[own, j], g[own], size))[:-1]
                hl = np.cumsum(np.bincount(code[own, j], h[own], size))[:-1]
                nl = np.cumsum(np.bincount(code[own, j], minlength=size))[:-1]
                left = np.clip(gl / (hl + l2), low[i], high[i])
                right = np.clip((total_g - gl) / (total_h - hl + l2), low[i], high[i])
                gain = gl * left - 0.5 * (hl + l2) * left ** 2 \
                    + (total_g - gl) * right - 0.5 * (total_h - hl + l2) * right ** 2 \
                    - (total_g * value[i] - 0.5 * (total_h + l2) * value[i] ** 2)
                ok = (nl >= least) & (len(own) - nl >= least)
                if monotone[j]:
                    ok &= monotone[j] * (right - left) >= 0
                gain = np.where(ok, gain, -np.inf)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (j, cuts[j][k], left[k], right[k]))
            a, b = 2 * i + 1, 2 * i + 2
            low[[a, b]], high[[a, b]] = low[i], high[i]
            if best[1] is None:  # all rows go left, with this node's value
                value[a] = value[b] = value[i]
                low[a] = high[a] = low[b] = high[b] = value[i]
                node[own] = a
                continue
            j, at, left, right = best[1]
            feature[i], threshold[i] = j, at
            middle = (left + right) / 2
            if monotone[j] > 0:
                high[a], low[b] = min(high[a], middle), max(low[b], middle)
            elif monotone[j] < 0:
                low[a], high[b] = max(low[a], middle), min(high[b], middle)
            node[own] = np.where(x[own, j] > at, b, a)
        for i in range(inner, nodes):
            own = node == i
            if own.any() and value[i] == 0:
                value[i] = np.clip(g[own].sum() / (h[own].sum() + l2), low[i], high[i])
        value *= rate
        raw += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), depth, base)

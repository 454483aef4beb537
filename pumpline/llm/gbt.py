"""Gradient-boosted trees for binary labels: histograms, second-order gains, numpy only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Trees of equal depth in heap order: split feature (-1: leaf), threshold and leaf value."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    start: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(e, x[:, j], side="right") if len(e) > 1 else x[:, j] >= (e[0] if len(e) else np.inf)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        b, out = self.bins(x), np.full(len(x), self.start)
        rows = np.arange(len(x)) * x.shape[1]
        flat = b.ravel()
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                split = f[at]
                go = 2 * at + 1 + (flat[rows + np.maximum(split, 0)] > c[at])
                at = np.where(split >= 0, go, at)
            out += v[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2,
        bins: int = 32, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Boost logistic loss; ``weight`` weighs rows.  No rows, or one class only, give a constant."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(d)]
    nodes = 2 ** (depth + 1) - 1
    total = weight.sum()
    p = (float((weight * y).sum()) + 1.0) / (float(total) + 2.0)
    model = Trees(edges, np.full((trees, nodes), -1), np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes)), float(np.log(p / (1 - p))))
    if not n or y.min() == y.max():
        return Trees(edges, model.feature[:0], model.cut[:0], model.value[:0], model.start * (4.0 if n else 1.0))
    b = model.bins(x).astype(np.int64)
    width = bins + 1
    margin = np.full(n, model.start)
    flat = b + np.arange(d) * width
    for t in range(trees):
        q = 1 / (1 + np.exp(-margin))
        g, h = weight * (q - y), weight * q * (1 - q)
        at = np.zeros(n, np.int64)
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            model.value[t, node] = -rate * gs / (hs + l2)
            if node >= 2 ** depth - 1:
                continue
            where = flat[rows].ravel()
            gl = np.bincount(where, np.repeat(g[rows], d), d * width).reshape(d, width).cumsum(axis=1)
            hl = np.bincount(where, np.repeat(h[rows], d), d * width).reshape(d, width).cumsum(axis=1)
            gain = gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs ** 2 / (hs + l2)
            gain[(hl < least / 4) | (hs - hl < least / 4)] = -1
            j, c = np.unravel_index(int(gain.argmax()), gain.shape)
            if gain[j, c] <= 1e-6:
                continue
            model.feature[t, node], model.cut[t, node] = j, c
            at[rows] = 2 * node + 1 + (b[rows, j] > c)
        margin += model.value[t, at]
    return model

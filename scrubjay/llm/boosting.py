"""Gradient-boosted regression trees for a binary label, on numpy arrays: logistic loss,
binned features, trees of fixed depth stored as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    start: float
    feature: np.ndarray    # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray       # trees x leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        out = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[row, feature[at]] > threshold[at])
            out += leaf[at - inner]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25,
              bins: int = 32, ridge: float = 1.0) -> Trees:
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    p0 = np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3)
    start = float(np.log(p0 / (1 - p0)))
    score, inner, leaves = np.full(len(y), start), 2 ** depth - 1, 2 ** depth
    out_f, out_t, out_v = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = w * (y - p), w * p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2 ** level - 1, 2 ** level
            local = at - first
            best = np.zeros(n)
            base = np.bincount(local, g, n) ** 2 / (np.bincount(local, h, n) + ridge)
            for j, b in enumerate(binned):
                k = len(edges[j]) + 1
                if k < 2:
                    continue
                cg = np.bincount(local * k + b, g, n * k).reshape(n, k).cumsum(axis=1)
                ch = np.bincount(local * k + b, h, n * k).reshape(n, k).cumsum(axis=1)
                gain = cg ** 2 / (ch + ridge) + (cg[:, -1:] - cg) ** 2 / (ch[:, -1:] - ch + ridge) - base[:, None]
                cut = gain[:, :-1].argmax(axis=1)
                top = gain[np.arange(n), cut]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                out_f[t, first + better], out_t[t, first + better] = j, edges[j][cut[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), out_f[t, at]] > out_t[t, at])
        leaf = at - inner
        out_v[t] = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        score += out_v[t][leaf]
    return Trees(start, out_f, out_t, out_v)

"""A small gradient-boosted tree classifier (logistic loss, binned features) in
numpy, for models fitted on a bounded sample and applied inside tasks."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth in arrays: node k has the children 2k+1 and 2k+2."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.l2 = trees, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], 1)  # bin b: value <= cuts[b]
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(p / (1 - p)))
        score, self.nodes = np.full(len(y), self.start), []
        for _ in range(self.trees):
            prob = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, cuts, y - prob, prob * (1 - prob))
            self.nodes.append(tree)
            score += self._apply(tree, x)
        return self

    def _grow(self, binned, cuts, g, h):
        size, inner = 2 ** (self.depth + 1) - 1, 2 ** self.depth - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = np.zeros(len(g), int)
        for k in range(size):
            rows = np.flatnonzero(at == k)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value[k] = self.rate * gs / (hs + self.l2)
            if k >= inner:
                continue
            best = (1e-9, -1, 0)
            for f in range(binned.shape[1]):
                if not len(cuts[f]):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g[rows], len(cuts[f]) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(cuts[f]) + 1))[:-1]
                gain = gl ** 2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs ** 2 / (hs + self.l2)
                c = int(gain.argmax())
                if gain[c] > best[0]:
                    best = (gain[c], f, c)
            if best[1] >= 0:
                feature[k], cut[k] = best[1], cuts[best[1]][best[2]]
                at[rows] = 2 * k + 1 + (binned[rows, best[1]] > best[2])
        return feature, cut, value

    def _apply(self, tree, x):
        feature, cut, value = tree
        at = np.zeros(len(x), int)
        for _ in range(self.depth):
            f = feature[at]
            go = f >= 0
            at[go] = 2 * at[go] + 1 + (x[go, f[go]] > cut[at[go]])
        return value[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities."""
        total = np.full(len(x), self.start)
        for t in self.nodes:
            total += self._apply(t, x)
        return 1 / (1 + np.exp(-total))


def calibrated_threshold(scores: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score from which held-out precision is never under
    ``precision``, by pooling adjacent violators (isotonic calibration); above
    every score if there is none."""
    order = np.argsort(scores, kind="stable")
    s, pools = scores[order], []
    for v in y[order]:
        pools.append([float(v), 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            a = pools.pop()
            pools[-1] = [pools[-1][0] + a[0], pools[-1][1] + a[1]]
    at = 0
    for total, n in pools:
        if total / n >= precision:
            return float(s[at])
        at += n
    return 2.0

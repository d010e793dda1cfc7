"""Small gradient-boosted trees, fitted on the driver and written out as column expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


class BoostedTrees:
    """Binary logistic boosting with Newton leaves. Feature i has the name names[i]."""

    def __init__(self, names: list[str], rounds: int = 24, depth: int = 3, rate: float = 0.3, leaf_weight: float = 1.0):
        self.names, self.rounds, self.depth, self.rate, self.leaf_weight = names, rounds, depth, rate, leaf_weight
        self.trees: list = []
        self.bias = 0.0

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
        total_g, total_h = g.sum(), h.sum()
        best = None
        if depth and len(x) > 1:
            for j in range(x.shape[1]):
                order = np.argsort(x[:, j], kind="stable")
                v, cg, ch = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
                at = np.flatnonzero(v[1:] > v[:-1])
                if not len(at):
                    continue
                gain = cg[at] ** 2 / (ch[at] + self.leaf_weight) + (total_g - cg[at]) ** 2 / (total_h - ch[at] + self.leaf_weight)
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[0] + 1e-12:
                    best = (gain[k], j, float((v[at[k]] + v[at[k] + 1]) / 2))
        if best is None or best[0] <= total_g**2 / (total_h + self.leaf_weight) + 1e-9:
            return float(self.rate * total_g / (total_h + self.leaf_weight))
        _, j, cut = best
        left = x[:, j] <= cut
        return (j, cut, self._grow(x[left], g[left], h[left], depth - 1), self._grow(x[~left], g[~left], h[~left], depth - 1))

    def _walk(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, cut, low, high = tree
        return np.where(x[:, j] <= cut, self._walk(low, x), self._walk(high, x))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(p / (1 - p)))
        margin = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(x, y - p, p * (1 - p), self.depth)
            self.trees.append(tree)
            margin += self._walk(tree, x)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sum(self._walk(t, x) for t in self.trees))))

    def column(self, features: Column) -> Column:
        """The score as an expression over a struct with one double field for each name."""

        def expr(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            j, cut, low, high = tree
            return F.when(features[self.names[j]] <= cut, expr(low)).otherwise(expr(high))

        margin = F.lit(self.bias)
        for tree in self.trees:
            margin = margin + expr(tree)
        return 1 / (1 + F.exp(-margin))

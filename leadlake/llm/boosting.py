"""Gradient-boosted trees for two classes, fitted on a bounded sample and kept as flat arrays.

Trees are complete binary trees of one depth in heap order, so a node's children are 2k+1 and 2k+2. A node that was not
split sends every row to the left. Features with a monotonic constraint can only push the score in one direction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; rows above it go right
    value: np.ndarray  # trees x leaves
    base: float

    @property
    def depth(self) -> int:
        return int(np.log2(self.value.shape[1]))

    def margin(self, features: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        rows = np.arange(len(features))
        total = np.full(len(features), self.base)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(features), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (features[rows, feature[node]] > threshold[node])
            total += value[node - (len(value) - 1)]
        return total

    def column(self, features: list[Column]) -> Column:
        """The same log-odds as a Spark expression."""
        def branch(t: int, node: int, level: int) -> Column:
            if level == self.depth:
                return F.lit(float(self.value[t, node - (self.value.shape[1] - 1)]))
            if not np.isfinite(self.threshold[t, node]):
                return branch(t, 2 * node + 1, level + 1)
            above = features[int(self.feature[t, node])] > F.lit(float(self.threshold[t, node]))
            return F.when(above, branch(t, 2 * node + 2, level + 1)).otherwise(branch(t, 2 * node + 1, level + 1))

        total = F.lit(float(self.base))
        for t in range(len(self.value)):
            total = total + branch(t, 0, 0)
        return total


def fit(features: np.ndarray, label: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 60, depth: int = 4,
        rate: float = 0.2, bins: int = 64, least_weight: float = 3.0, ridge: float = 1.0) -> Forest:
    """Boost ``trees`` trees on log-loss. ``monotone`` maps a feature to +1 (may only raise the score) or -1.

    Splits are searched over at most ``bins`` quantiles of each feature; a child needs a Hessian of ``least_weight``.
    """
    monotone = monotone or {}
    n, width = features.shape
    cuts = [np.unique(np.quantile(features[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(c, features[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    positive = min(max(label.mean(), 1e-4), 1 - 1e-4)
    base = float(np.log(positive / (1 - positive)))
    margin = np.full(n, base)
    inner, leaves = 2 ** depth - 1, 2 ** depth
    out_feature, out_threshold, out_value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = label - p, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for k in range(inner):
            low[2 * k + 1] = low[2 * k + 2] = low[k]
            high[2 * k + 1] = high[2 * k + 2] = high[k]
            rows = np.flatnonzero(node == k)
            best = (1e-6, None)
            if len(rows) > 1:
                g, h = gradient[rows], hessian[rows]
                whole = g.sum() ** 2 / (h.sum() + ridge)
                for f, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    gl = np.cumsum(np.bincount(binned[rows, f], g, len(cut) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, f], h, len(cut) + 1))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    left = np.clip(gl / (hl + ridge), low[k], high[k])
                    right = np.clip(gr / (hr + ridge), low[k], high[k])
                    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - whole
                    gain[(hl < least_weight) | (hr < least_weight)] = 0
                    if f in monotone:
                        gain[(right - left) * monotone[f] < 0] = 0
                    at = int(np.argmax(gain))
                    if gain[at] > best[0]:
                        best = (gain[at], f, at, left[at], right[at])
            if best[1] is not None:
                _, f, at, left, right = best
                feature[k], threshold[k] = f, cuts[f][at]
                if f in monotone:
                    middle = (left + right) / 2
                    if monotone[f] > 0:
                        high[2 * k + 1], low[2 * k + 2] = middle, middle
                    else:
                        low[2 * k + 1], high[2 * k + 2] = middle, middle
                node[rows] = 2 * k + 1 + (binned[rows, f] > at)
            else:
                node[rows] = 2 * k + 1
        leaf = node - inner
        g = np.bincount(leaf, gradient, leaves)
        h = np.bincount(leaf, hessian, leaves)
        value = rate * np.clip(g / (h + ridge), low[inner:], high[inner:])
        value[~np.isfinite(value)] = 0.0
        margin += value[leaf]
        out_feature.append(feature)
        out_threshold.append(threshold)
        out_value.append(value)
    return Forest(np.array(out_feature), np.array(out_threshold), np.array(out_value), base)

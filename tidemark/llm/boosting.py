"""Small gradient-boosted trees in NumPy, for models fitted on a bounded sample.

Features are binned once; trees are grown level by level to a fixed depth as complete binary trees, so
a whole batch is scored with one array operation per level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """``loss``: ``squared`` or ``logistic``. Scores are values or log odds."""

    loss: str = "squared"
    trees: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 32
    least: float = 3.0
    shrink: float = 1.0
    seed: int = 7
    rows: float = 0.8
    columns: float = 1.0
    base: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """Fit to rows of ``x`` and targets ``y`` (0 or 1 for the logistic loss)."""
        rng = np.random.default_rng(self.seed)
        n, width = x.shape
        edges = []
        binned = np.zeros((n, width), dtype=np.int32)
        for j in range(width):
            points = np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1]))
            points = points[points < x[:, j].max()] if len(points) else points
            edges.append(points)
            binned[:, j] = np.searchsorted(points, x[:, j], side="left")
        self.features, self.cuts, self.leaves = [], [], []
        mean = y.mean()
        self.base = float(np.log((mean + 1e-6) / (1 - mean + 1e-6))) if self.loss == "logistic" else float(mean)
        score = np.full(n, self.base)
        most = self.bins + 1
        live = np.array([j for j in range(width) if len(edges[j])], dtype=np.int32)  # columns that are not constant
        varied = live
        for _ in range(self.trees):
            if self.loss == "logistic":
                p = 1 / (1 + np.exp(-score))
                gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
            else:
                gradient, weight = y - score, np.ones(n)
            use = rng.random(n) < self.rows
            live = varied if self.columns >= 1 else np.sort(rng.choice(varied, max(1, int(len(varied) * self.columns)), replace=False)) if len(varied) else varied
            width = len(live)
            inside = np.arange(most) < np.array([len(edges[j]) for j in live]).reshape(-1, 1)
            spots = binned[np.ix_(use, live)] + np.arange(width, dtype=np.int32) * most
            pull, mass = np.repeat(gradient[use], width), np.repeat(weight[use], width)
            nodes = 2**self.depth - 1
            feature, cut = np.zeros(nodes, dtype=np.int32), np.full(nodes, np.inf)
            node = np.zeros(n, dtype=np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                local = node - first
                # histograms of all features in one count: node, feature, bin
                key = (local[use].astype(np.int32) * (width * most))[:, None] + spots
                shape = (count, width, most)
                g = np.bincount(key.ravel(), pull, count * width * most).reshape(shape)
                h = np.bincount(key.ravel(), mass, count * width * most).reshape(shape)
                gl, hl = g.cumsum(2), h.cumsum(2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + self.shrink) + (gt - gl) ** 2 / (ht - hl + self.shrink) - gt**2 / (ht + self.shrink)
                least = self.least * (0.02 if self.loss == "logistic" else 1.0)
                gain = np.where((hl >= least) & (ht - hl >= least) & inside, gain, 0).reshape(count, -1)
                at = gain.argmax(1) if width else np.zeros(count, dtype=int)
                for k in (np.flatnonzero(gain[np.arange(count), at] > 1e-9) if width else ()):
                    feature[first + k], cut[first + k] = live[at[k] // most], edges[live[at[k] // most]][at[k] % most]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - nodes
            g, h = np.bincount(leaf[use], gradient[use], nodes + 1), np.bincount(leaf[use], weight[use], nodes + 1)
            value = self.rate * g / (h + self.shrink)
            self.features.append(feature)
            self.cuts.append(cut)
            self.leaves.append(value)
            score += value[leaf]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Values or log odds of rows."""
        out = np.full(len(x), self.base)
        at = np.arange(len(x))
        for feature, cut, value in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[at, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probabilities under the logistic loss."""
        return 1 / (1 + np.exp(-self.score(x)))

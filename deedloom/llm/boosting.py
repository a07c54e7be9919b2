"""Gradient-boosted trees for several classes, on binned features; small enough to send to every task."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A complete binary tree: at node i the feature and the bin up to which rows go to 2i + 1; leaves have values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, binned: np.ndarray) -> np.ndarray:
        inner, width = len(self.feature), binned.shape[1]
        flat, row = binned.ravel(), np.arange(len(binned)) * width
        node = np.zeros(len(binned), dtype=np.int64)
        for _ in range(int(inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (flat[row + self.feature[node]] > self.threshold[node])
        return self.value[node - inner]


@dataclass
class BoostedTrees:
    """Softmax boosting; at most ``rounds`` trees of ``depth`` a class, fewer if the mean loss falls under ``enough`` before.

    Deterministic: no sampling of rows or features.
    """

    classes: int
    rounds: int = 40
    depth: int = 4
    rate: float = 0.2
    bins: int = 48
    smooth: float = 1.0
    enough: float = 0.0005
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[list[Tree]] = field(default_factory=list)
    start: np.ndarray | None = None

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1) if len(self.edges) else x

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> Tree:
        inner = 2**self.depth - 1
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, self.bins, dtype=np.int64)
        node = np.zeros(len(binned), dtype=np.int64)
        width = max(len(e) for e in self.edges) + 1
        rows, features = binned.shape
        columns = np.arange(features)
        # All features' histograms of a level are one count, over cells of (node, feature, bin).
        g_each, h_each = np.repeat(gradient, features), np.repeat(hessian, features)
        for level in range(self.depth):
            first, n = 2**level - 1, 2**level
            cell = (((node - first)[:, None] * features + columns) * width + binned).ravel()
            g = np.bincount(cell, g_each, n * features * width).reshape(n, features, width).cumsum(2)
            h = np.bincount(cell, h_each, n * features * width).reshape(n, features, width).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + self.smooth) + (gt - g) ** 2 / (ht - h + self.smooth) - gt**2 / (ht + self.smooth)
            gain[(h < 1) | (ht - h < 1)] = 0
            flat = gain.reshape(n, -1)
            top = flat.argmax(1)
            won = flat[np.arange(n), top] > 1e-6
            feature[first : first + n][won], threshold[first : first + n][won] = top[won] // width, top[won] % width
            node = 2 * node + 1 + (binned[np.arange(rows), feature[node]] > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
        return Tree(feature, threshold, -self.rate * g / (h + self.smooth))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        x, weight = np.nan_to_num(np.asarray(x, dtype=float)), np.ones(len(x)) if weight is None else weight
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins)[1:-1])) for j in range(x.shape[1])]
        binned = self._binned(x)
        prior = np.array([weight[y == c].sum() + 1 for c in range(self.classes)])
        self.start = np.log(prior / prior.sum())
        scores = np.tile(self.start, (len(x), 1))
        self.trees = []
        for _ in range(self.rounds):
            p = softmax(scores)
            if -np.log(p[np.arange(len(x)), y] + 1e-12).mean() < self.enough:
                break
            turn = []
            for c in range(self.classes):
                tree = self._grow(binned, (p[:, c] - (y == c)) * weight, np.maximum(p[:, c] * (1 - p[:, c]), 1e-6) * weight)
                turn.append(tree)
                scores[:, c] += tree.predict(binned)
            self.trees.append(turn)
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(np.nan_to_num(np.asarray(x, dtype=float)))
        out = np.tile(self.start, (len(x), 1))
        for turn in self.trees:
            for c, tree in enumerate(turn):
                out[:, c] += tree.predict(binned)
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Calibration:
    """Probabilities from scores by a slope for all classes and an offset for each, fitted on a holdout."""

    slope: float = 1.0
    offset: np.ndarray | None = None

    def fit(self, scores: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.1, pull: float = 0.01) -> Calibration:
        classes = scores.shape[1]
        slope, offset, truth = 1.0, np.zeros(classes), np.eye(classes)[y]
        for _ in range(steps if len(y) else 0):
            error = softmax(slope * scores + offset) - truth
            slope -= rate * (float((error * scores).sum(1).mean()) + pull * (slope - 1))
            slope = max(slope, 0.05)
            offset -= rate * (error.mean(0) + pull * offset)
        self.slope, self.offset = slope, offset
        return self

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        return softmax(self.slope * scores + (0 if self.offset is None else self.offset))

"""Gradient-boosted trees for a few classes, fitted on binned columns and applied to whole arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

ROUNDS = 20
LEVELS = 4
RATE = 0.3
BINS = 32
RIDGE = 1.0


class Trees(NamedTuple):
    """Complete trees, by round and class: columns and thresholds of the inner nodes, values of the leaves."""

    column: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-probabilities of the classes, a row for each row of ``x``."""
        rounds, classes, _ = self.column.shape
        out, rows = np.zeros((len(x), classes)), np.arange(len(x))
        for r in range(rounds):
            for c in range(classes):
                place = np.zeros(len(x), np.int64)
                for _ in range(LEVELS):
                    place = 2 * place + 1 + (x[rows, self.column[r, c][place]] > self.threshold[r, c][place])
                out[:, c] += self.value[r, c][place - (2**LEVELS - 1)]
        return _log_softmax(out)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def fit(x: np.ndarray, label: np.ndarray, classes: int, rounds: int = ROUNDS) -> Trees:
    """Newton steps on the softmax loss; each split is the best of all columns and their quantile bins."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    bins = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)])
    rows = np.arange(len(x))
    inner, leaves = 2**LEVELS - 1, 2**LEVELS
    column = np.zeros((rounds, classes, inner), np.int64)
    threshold = np.full((rounds, classes, inner), np.inf)
    value = np.zeros((rounds, classes, leaves))
    score = np.zeros((len(x), classes))
    for r in range(rounds):
        chance = np.exp(_log_softmax(score))
        for c in range(classes):
            slope, curve = chance[:, c] - (label == c), chance[:, c] * (1 - chance[:, c]) + 1e-9
            place = np.zeros(len(x), np.int64)
            for level in range(LEVELS):
                first, wide = 2**level - 1, 2**level
                gains = np.full((x.shape[1], wide, BINS), -np.inf)
                base = (place - first) * BINS
                for k in range(x.shape[1]):
                    key = base + bins[k]
                    g, h = (np.bincount(key, v, wide * BINS).reshape(wide, BINS).cumsum(1) for v in (slope, curve))
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + RIDGE) + (total_g - g)**2 / (total_h - h + RIDGE) - total_g**2 / (total_h + RIDGE)
                    gains[k, :, :len(edges[k])] = gain[:, :len(edges[k])]
                best = gains.transpose(1, 0, 2).reshape(wide, -1).argmax(1)
                chosen, cut = best // BINS, best % BINS
                useful = gains[chosen, np.arange(wide), cut] > 1e-6
                column[r, c, first:first + wide] = np.where(useful, chosen, 0)
                threshold[r, c, first:first + wide] = [edges[k][b] if u else np.inf for k, b, u in zip(chosen, cut, useful)]
                at = place - first
                right = (bins[chosen[at], rows] > cut[at]) & useful[at]
                place = 2 * place + 1 + right
            leaf = place - inner
            g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, curve, leaves)
            value[r, c] = -RATE * g / (h + RIDGE)
            score[:, c] += value[r, c][leaf]
    return Trees(column, threshold, value)

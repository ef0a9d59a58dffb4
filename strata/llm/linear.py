"""Sparse softmax regression, trained with follow-the-regularised-leader and elastic-net penalties."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: One labelled row: feature indices, their values, the number of its class.
Row = tuple[np.ndarray, np.ndarray, int]


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates; `l1` makes weights exactly zero, `l2` shrinks the rest."""

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0
    epochs: int = 3
    seed: int = 7

    def fit(self, rows: Sequence[Row], features: int, classes: int) -> np.ndarray:
        """Weights of shape (features + 1, classes); the last line is the intercept."""
        z = np.zeros((features + 1, classes))
        n = np.zeros_like(z)
        # The first class is the reference, so that two classes have one line of weights.
        free = np.ones(classes)
        free[0] = 0.0 if classes == 2 else 1.0
        rng = np.random.default_rng(self.seed)
        for _ in range(self.epochs):
            for k in rng.permutation(len(rows)):
                index, value, label = rows[k]
                at = np.append(index, features)
                x = np.append(value, 1.0)
                w = self._weights(z[at], n[at])
                error = softmax(x @ w)
                error[label] -= 1.0
                g = x[:, None] * (error * free)[None, :]
                squared = n[at] + g * g
                z[at] += g - (np.sqrt(squared) - np.sqrt(n[at])) / self.alpha * w
                n[at] = squared
        return self._weights(z, n)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        kept = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -kept / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def logits_of(weights: np.ndarray, rows: Sequence[Row]) -> np.ndarray:
    if not rows:
        return np.zeros((0, weights.shape[1]))
    return np.stack([value @ weights[index] + weights[-1] for index, value, _ in rows])


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on rows that were not trained on."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20.0, 121)
    losses = []
    for t in grid:
        p = softmax(logits / t)[np.arange(len(labels)), labels]
        losses.append(-np.log(np.maximum(p, 1e-12)).mean())
    return float(grid[int(np.argmin(losses))])

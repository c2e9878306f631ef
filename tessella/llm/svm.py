"""Linear support vector machines by dual coordinate descent on sparse rows, and calibration of their margins.

The rows are a bounded sample, so they fit into one process; applying a model is a sum over the features of each text
and runs where the texts are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows: row i has ``index[bounds[i]:bounds[i + 1]]`` with values alike placed."""

    bounds: np.ndarray
    index: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        bounds = np.concatenate([[0], np.cumsum([len(i) for i, _ in rows])]).astype(np.int64)
        if not rows:
            return cls(bounds, np.zeros(0, np.int64), np.zeros(0))
        return cls(bounds, np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(float))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def pick(self, rows: np.ndarray) -> Rows:
        return Rows.of([(self.index[a:b], self.value[a:b]) for a, b in zip(self.bounds[rows], self.bounds[rows + 1], strict=True)])

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The product with a vector, one number a row."""
        sums = np.concatenate([[0.0], np.cumsum(weights[self.index] * self.value)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def spread(self, factors: np.ndarray, size: int) -> np.ndarray:
        """The sum of all rows, each times its factor."""
        return np.bincount(self.index, self.value * np.repeat(factors, np.diff(self.bounds)), size)


def train(rows: Rows, positive: np.ndarray, size: int, cost: float = 1.0, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise half the squared norm plus ``cost`` times the hinge losses.

    Each step takes the dual variable of one row to its best value within [0, cost]; the two classes share
    the cost equally. Rows of one class only give zero weights and a bias of that sign.
    """
    weights, bias = np.zeros(size), 0.0
    n, plus = len(rows), int(positive.sum())
    if plus in (0, n):
        return weights, float(np.sign(2 * plus - n))
    sign = np.where(positive, 1.0, -1.0)
    most = cost * np.where(positive, n / (2 * plus), n / (2 * (n - plus)))
    sums = np.concatenate([[0.0], np.cumsum(rows.value**2)])
    square = sums[rows.bounds[1:]] - sums[rows.bounds[:-1]] + 1.0
    dual = np.zeros(n)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(n):
            low, high = rows.bounds[i], rows.bounds[i + 1]
            index, value = rows.index[low:high], rows.value[low:high]
            slope = sign[i] * (weights[index] @ value + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), most[i])
            step = (new - dual[i]) * sign[i]
            if step:
                dual[i] = new
                weights[index] += step * value  # a row names a feature once
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return weights, bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.clip(x, -60, 60)))


def calibrate(margin: np.ndarray, positive: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(slope, shift) of the sigmoid that turns margins of rows not trained on into probabilities, by
    Newton steps on the log loss with smoothed targets."""
    plus, minus = int(positive.sum()), int((~positive).sum())
    if not plus or not minus:
        return 1.0, 0.0
    target = np.where(positive, (plus + 1) / (plus + 2), 1 / (minus + 2))
    scale = max(float(np.std(margin)), 1e-9)
    x = np.stack([margin / scale, np.ones(len(margin))])
    found = np.array([1.0, np.log(plus / minus)])
    for _ in range(steps):
        p = sigmoid(found @ x)
        slope = x @ (p - target) + 1e-4 * found
        curve = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-4 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        found -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(found[0] / scale), 1e-6), float(found[1])

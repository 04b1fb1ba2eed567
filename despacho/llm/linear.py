"""Sparse rows over hashed features, and a linear model trained by non-negative positive-unlabelled risk."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rows:
    """Sparse matrix by rows: row ``i`` holds ``values`` at ``columns`` from ``bounds[i]`` to ``bounds[i + 1]``."""

    bounds: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner(), self.values * weights[self.columns], minlength=len(self))

    def add_up(self, factors: np.ndarray, width: int) -> np.ndarray:
        """The transposed product: for each column the sum of its values times their row's factor."""
        return np.bincount(self.columns, self.values * factors[self.owner()], minlength=width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def train_nnpu(
    positive: Rows, unlabelled: Rows, width: int, prior: float, steps: int = 300, rate: float = 0.05, l2: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))  under the logistic loss.

    R_p(+) is the mean loss of positives taken as positive, R(-) that of rows
    taken as negative. Where the corrected negative part falls below zero the
    step goes up its gradient instead, so that it isn't fitted below zero.
    """
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        zp, zu = positive.dot(w) + b, unlabelled.dot(w) + b
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # Gradients of each loss with respect to the scores.
        p_plus = -prior * sigmoid(-zp) / len(positive)
        p_minus = -prior * sigmoid(zp) / len(positive)
        u_minus = sigmoid(zu) / len(unlabelled)
        if negative_risk >= 0:
            gp, gu = p_plus + p_minus, u_minus
        else:
            gp, gu = -p_minus, -u_minus
        gradient = np.append(
            positive.add_up(gp, width) + unlabelled.add_up(gu, width) + l2 * w, gp.sum() + gu.sum()
        )
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b

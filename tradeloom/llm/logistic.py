"""Ridge-penalised logistic regression on a few standardised features."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass
class Classifier:
    """Logistic regression on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float  # share of labels 1

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(self.weights[0] + z @ self.weights[1:], -12, 12)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Classifier:
    """Ridge-penalised logistic regression by Newton steps."""
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(y) == 0 or y.min() == y.max():
        zero = np.zeros(x.shape[1])
        return Classifier(zero, zero + 1, np.array([math.log(prior / (1 - prior)), *zero]), prior)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    w = np.zeros(z.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (len(w) - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, w, prior)

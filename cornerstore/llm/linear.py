"""Logistic regression on sparse rows of a bounded sample, for the learned scorers."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train_logistic(
    lengths: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, features: int,
    l2: float = 1e-3, rounds: int = 200, rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the cross-entropy to soft targets, by Adam over the whole sample.

    Row i has ``lengths[i]`` entries of ``columns`` and ``values``, one after the other.
    """
    rows = np.repeat(np.arange(len(lengths)), lengths)
    weights, bias = np.zeros(features), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    m, v, bm, bv = np.zeros(features), np.zeros(features), 0.0, 0.0
    for t in range(1, rounds + 1):
        score = bias + np.bincount(rows, weights[columns] * values, minlength=len(lengths))
        error = (sigmoid(score) - target) / len(lengths)
        slope = np.bincount(columns, error[rows] * values, minlength=features) + l2 * weights / len(lengths)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        bm, bv = 0.9 * bm + 0.1 * error.sum(), 0.99 * bv + 0.01 * error.sum() ** 2
        fix, fix2 = 1 - 0.9**t, 1 - 0.99**t
        weights -= rate * (m / fix) / (np.sqrt(v / fix2) + 1e-9)
        bias -= rate * (bm / fix) / (np.sqrt(bv / fix2) + 1e-9)
    return weights, bias

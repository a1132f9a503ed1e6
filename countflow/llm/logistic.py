"""Logistic regression in numpy, for models of bounded size."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Coefficients, the intercept last, by Newton's method; ``ridge`` doesn't touch the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-9])
    weight = weight / weight.sum()
    for _ in range(steps):
        p = sigmoid(x @ beta)
        grad = x.T @ (weight * (p - y)) + penalty @ beta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(hess, grad)
        beta = beta - step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_sparse(index: np.ndarray, value: np.ndarray, begin: np.ndarray, y: np.ndarray, size: int, ridge: float, steps: int, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and intercept for rows in compressed form (``begin``: each row's first entry, then the end), by Adam on all rows."""
    rows = np.repeat(np.arange(len(y)), np.diff(begin))
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, steps + 1):
        p = sigmoid(np.bincount(rows, value * w[index], len(y)) + b)
        err = (p - y) / len(y)
        g = np.bincount(index, value * err[rows], size) + ridge * w
        gb = err.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, b

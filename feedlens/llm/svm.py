"""A linear support vector machine for small dense problems."""

from __future__ import annotations

import numpy as np


def fit_linear_svm(x: np.ndarray, positive: np.ndarray, cost: float = 1.0, epochs: int = 30,
                   seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised squared-hinge machine, by dual coordinate descent.

    The two classes weigh the same, however many rows each has.
    """
    y = np.where(positive, 1.0, -1.0)
    n = len(y)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    diagonal = share / cost  # 1 / (2 C_i) with C_i = cost / (2 share_i)
    x = np.hstack([x, np.ones((n, 1), x.dtype)])
    squares = (x * x).sum(axis=1) + diagonal
    alpha, w, rng = np.zeros(n), np.zeros(x.shape[1]), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(n):
            slope = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / squares[i], 0.0)
            if new != alpha[i]:
                moved = max(moved, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if moved < 1e-4:
            break
    return w[:-1], float(w[-1])


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, offset) of a logistic curve over margins, with smoothed targets; the slope is never negative."""
    p, n = positive.sum(), (~positive).sum()
    target = np.where(positive, (p + 1) / (p + 2), 1 / (n + 2))
    weight = np.where(positive, 0.5 / max(p, 1), 0.5 / max(n, 1)) * len(margins)
    a, b = 1.0, 0.0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (q - target), weight * q * (1 - q) + 1e-9
        grad = np.array([(g * margins).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return (a, b) if np.isfinite(a) and a > 0 else (1.0, 0.0)

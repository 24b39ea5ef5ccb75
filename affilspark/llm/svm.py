"""Linear support vector machines by dual coordinate descent, for bounded training sets."""

from __future__ import annotations

import numpy as np


Rows = list[tuple[np.ndarray, np.ndarray]]


def fit(rows: Rows, size: int, y: np.ndarray, c: float | np.ndarray = 1.0, epochs: int = 20, tol: float = 1e-3, seed: int = 0) -> np.ndarray:
    """size + 1 weights (the last one a bias) of the L1-loss SVM; y is -1 or 1, c may differ by row.

    A row is its indices and their values. Coordinate descent on the dual: each step solves one dual
    variable exactly and moves w along its row. The order of rows is drawn anew each epoch from `seed`.
    One class alone gives its bias only.
    """
    w = np.zeros(size + 1)
    if len(set(y.tolist())) < 2:
        w[-1] = float(y[0]) if len(y) else 0.0
        return w
    norm = [float(v @ v) + 1.0 for _, v in rows]
    top = np.broadcast_to(np.asarray(c, float), len(y)).tolist()
    alpha = [0.0] * len(y)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)).tolist():
            at, v = rows[i]
            g = y[i] * (float(v @ w[at]) + w[-1]) - 1
            new = min(max(alpha[i] - g / norm[i], 0.0), top[i])
            if new != alpha[i]:
                move = (new - alpha[i]) * y[i]
                w[at] += move * v
                w[-1] += move
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < tol:
            break
    return w


def margins(rows: Rows, w: np.ndarray) -> np.ndarray:
    return np.array([float(v @ w[at]) + w[-1] for at, v in rows])


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, steps: int = 50) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), fitted by Newton steps to smoothed targets."""
    weight = np.ones(len(y)) if weight is None else weight
    up, down = weight[y > 0].sum(), weight[y <= 0].sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    design = np.stack([margin, np.ones(len(y))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (p - goal))
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta -= np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])

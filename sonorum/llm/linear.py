"""Linear hinge-loss models on sparse indicator rows, for use inside one task on a bounded sample."""

from __future__ import annotations

import numpy as np


def log_count_ratios(rows: list[np.ndarray], positive: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    """log of each feature's share among positive rows over its share among negative rows."""
    counts = []
    for side in (positive, ~positive):
        own = [rows[i] for i in np.flatnonzero(side)]
        c = alpha + np.bincount(np.concatenate(own), minlength=size) if own else np.full(size, alpha)
        counts.append(c / c.sum())
    return np.log(counts[0] / counts[1])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], positive: np.ndarray, size: int, cost: float = 1.0, epochs: int = 10, seed: int = 3) -> np.ndarray:
    """Weights of a linear hinge-loss model; the last weight is the bias.

    One dual variable for each row is moved to its optimum in turn, in random order; each class has
    the same total cost. rows: feature numbers below size; values: beside them.
    """
    weights = np.zeros(size + 1)
    y = np.where(positive, 1.0, -1.0)
    share = max(1, positive.sum()), max(1, (~positive).sum())
    most = cost * np.where(positive, len(rows) / (2 * share[0]), len(rows) / (2 * share[1]))
    dual = np.zeros(len(rows))
    square = np.array([v @ v for v in values]) + 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = y[i] * (weights[x] @ v + weights[size]) - 1.0
            new = min(max(dual[i] - gradient / square[i], 0.0), most[i])
            if step := (new - dual[i]) * y[i]:
                weights[x] += step * v
                weights[size] += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_sigmoid(margins: np.ndarray, positive: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, shift) so that sigmoid(slope * margin + shift) is the chance of a positive: Newton with damping."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(steps):
        p = sigmoid(a * margins + b)
        g, w = p - target, p * (1 - p) + 1e-9
        h = np.array([[(w * margins * margins).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(g * margins).sum() + 1e-3 * (a - 1), g.sum()])
        step = min(1.0, 2.0 / max(1e-9, abs(da), abs(db)))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(a), float(b)

"""A small logistic regression for bounded tables of weighted examples."""

from __future__ import annotations

import numpy as np


def regression(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, ridge: float = 1.0) -> np.ndarray:
    """Weights, then the bias, by Newton steps; ``y`` may be shares. The bias carries no penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.ones(len(x)) if weights is None else weights
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, x.T @ (weights * (y - p)) - penalty @ w)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w

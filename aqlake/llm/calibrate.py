"""Logistic calibration of one number to a probability."""

from __future__ import annotations

import numpy as np


def fit_logistic(x, y, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | x), by Newton's method on smoothed targets (Platt).

    Without rows of both classes the targets are still between 0 and 1, so the fit exists;
    without any rows it is (1, 0).
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    if not len(x):
        return 1.0, 0.0
    mean, spread = float(x.mean()), float(x.std()) or 1.0
    z = np.stack([(x - mean) / spread, np.ones(len(x))], axis=1)
    good = y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - target) + ridge * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def logistic(x, slope: float, offset: float):
    return 1 / (1 + np.exp(-np.clip(np.asarray(x, float) * slope + offset, -30, 30)))

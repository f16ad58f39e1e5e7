"""Ridge logistic regression and Platt calibration on small dense samples (numpy, on the driver)."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Standardised features; Newton steps; ``weights`` last entry is the intercept."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, sample_weight: np.ndarray | None = None):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.scale[self.scale < 1e-6] = 1.0
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        s = np.ones(len(y)) if sample_weight is None else sample_weight
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-3
        w = np.zeros(z.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (s * (p - y)) + penalty * w
            hess = (z * (s * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-9))
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def prob(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))

"""Linear support vector machines by dual coordinate descent, for samples that fit one process."""

from __future__ import annotations

import numpy as np


def train(features: np.ndarray, positive: np.ndarray, cost: float = 1.0, passes: int = 30, seed: int = 1) -> np.ndarray:
    """Weights (the last one is the bias) that separate rows marked ``positive`` from the others, hinge loss.

    Both sides weigh alike in total, however many rows each has.
    """
    rows = np.ones((len(features), features.shape[1] + 1))  # the only copy: samples are held in the driver
    rows[:, :-1] = features
    sign = np.where(positive, 1.0, -1.0)
    limit = cost * np.where(positive, len(rows) / (2 * max(1, positive.sum())),
                            len(rows) / (2 * max(1, (~positive).sum())))
    squares = np.array([(row ** 2).sum() for row in rows])
    weights, alpha = np.zeros(rows.shape[1]), np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for at in order.permutation(len(rows)):
            if not squares[at]:
                continue
            slope = sign[at] * (rows[at] @ weights) - 1
            new = min(max(alpha[at] - slope / squares[at], 0.0), limit[at])
            if new != alpha[at]:
                weights += (new - alpha[at]) * sign[at] * rows[at]
                moved = max(moved, abs(new - alpha[at]))
                alpha[at] = new
        if moved < 1e-3:
            break
    return weights

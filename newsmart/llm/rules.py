"""Rule ensembles: trees grown on a sample, their paths as conjunctive rules, lasso logistic weights for the rules."""

from __future__ import annotations

import numpy as np

Condition = tuple[int, bool, float]  # column, whether it must be greater, threshold


def grow(values: np.ndarray, gradients: np.ndarray, thresholds: list[np.ndarray], columns: np.ndarray, depth: int,
         least: int, path: tuple[Condition, ...] = ()) -> list[tuple[tuple[Condition, ...], np.ndarray, float]]:
    """Leaves (path, rows as a mask, mean gradient) of a regression tree, and through ``path`` its rules."""
    leaves = []

    def split(rows: np.ndarray, path: tuple[Condition, ...], left: int) -> None:
        total, count = gradients[rows].sum(), rows.sum()
        best = (0.0, None)
        for column in columns if left else ():
            for threshold in thresholds[column]:
                above = rows & (values[:, column] > threshold)
                high = above.sum()
                if high < least or count - high < least:
                    continue
                part = gradients[above].sum()
                gain = part ** 2 / high + (total - part) ** 2 / (count - high) - total ** 2 / count
                if gain > best[0] + 1e-12:
                    best = (gain, (int(column), float(threshold), above))
        if best[1] is None:
            leaves.append((path, rows, total / max(1, count)))
            return
        column, threshold, above = best[1]
        split(above, (*path, (column, True, threshold)), left - 1)
        split(rows & ~above, (*path, (column, False, threshold)), left - 1)

    split(np.ones(len(values), bool), path, depth)
    return leaves


def simplified(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """The tightest bound per column and direction, in order."""
    bounds: dict[tuple[int, bool], float] = {}
    for column, greater, threshold in path:
        old = bounds.get((column, greater), threshold)
        bounds[column, greater] = max(old, threshold) if greater else min(old, threshold)
    return tuple(sorted((column, greater, threshold) for (column, greater), threshold in bounds.items()))


def extract(values: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 3, cuts: int = 24, seed: int = 1,
            rate: float = 0.3) -> list[tuple[Condition, ...]]:
    """Different rules of a boosted ensemble: every node but the root is the conjunction of the splits above it."""
    draws = np.random.default_rng(seed)
    thresholds = [np.unique(np.quantile(column, np.linspace(0, 1, cuts + 2)[1:-1])) for column in values.T]
    margin, rules = np.full(len(values), np.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6))), {}
    some = max(1, int(np.ceil(values.shape[1] * 0.6)))
    for _ in range(trees):
        columns = draws.choice(values.shape[1], some, replace=False)
        chance = 1 / (1 + np.exp(-margin))
        for path, rows, mean in grow(values, labels - chance, thresholds, columns, depth, max(5, len(values) // 200)):
            margin[rows] += rate * 4 * mean
            for end in range(1, len(path) + 1):
                rules.setdefault(simplified(path[:end]))
    return list(rules)


def holds(values: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(values), bool)
    for column, greater, threshold in rule:
        out &= (values[:, column] > threshold) == greater
    return out


def lasso(matrix: np.ndarray, labels: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Bias and weights of logistic regression with an absolute penalty, by accelerated proximal steps."""
    count, width = matrix.shape
    rows = matrix.astype(np.float64)
    # The bound on curvature: a quarter of the largest eigenvalue, by power iteration.
    probe = np.ones(width + 1)
    full = np.concatenate([rows, np.ones((count, 1))], axis=1)
    for _ in range(30):
        probe = full.T @ (full @ probe)
        probe /= np.linalg.norm(probe)
    pace = 4 * count / max(1e-12, float(probe @ (full.T @ (full @ probe))))
    weights, ahead, momentum = np.zeros(width + 1), np.zeros(width + 1), 1.0
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(full @ ahead, -30, 30)))
        new = ahead - pace * (full.T @ (chance - labels)) / count
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - pace * penalty, 0)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = new + (momentum - 1) / next_momentum * (new - weights)
        weights, momentum = new, next_momentum
    return float(weights[-1]), weights[:-1]

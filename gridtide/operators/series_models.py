"""Tree and penalised models for one short series: plain functions of (x, y, new x).

A series has one row per month, so a fit sees some dozens of rows; they run inside the grouped step
that holds the series.
"""

from __future__ import annotations

import numpy as np

LEAST = 2  # rows in a leaf
Tree = tuple | float


def grow(x: np.ndarray, y: np.ndarray, depth: int) -> Tree:
    """A regression tree: a mean, or (feature, limit, tree up to it, tree beyond)."""
    n = len(y)
    if not depth or n < 2 * LEAST or not x.shape[1] or (y == y[0]).all():
        return float(y.mean())
    order = np.argsort(x, axis=0, kind="stable")
    values, sums = np.take_along_axis(x, order, axis=0), np.cumsum(y[order], axis=0)
    count = np.arange(1, n)[:, None]
    # the squared error falls by as much as this rises
    gain = sums[:-1] ** 2 / count + (sums[-1] - sums[:-1]) ** 2 / (n - count)
    gain[values[1:] <= values[:-1]] = -np.inf
    gain[: LEAST - 1] = gain[n - LEAST :] = -np.inf
    row, feature = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[row, feature] <= y.sum() ** 2 / n * (1 + 1e-12):
        return float(y.mean())
    limit = (values[row, feature] + values[row + 1, feature]) / 2
    low = x[:, feature] <= limit
    return int(feature), float(limit), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def fall(tree: Tree, x: np.ndarray) -> np.ndarray:
    """What a tree predicts for each row."""
    if isinstance(tree, float):
        return np.full(len(x), tree)
    feature, limit, low_tree, high_tree = tree
    low = x[:, feature] <= limit
    out = np.empty(len(x))
    out[low], out[~low] = fall(low_tree, x[low]), fall(high_tree, x[~low])
    return out


def one_tree(x: np.ndarray, y: np.ndarray, new: np.ndarray, depth: int = 5) -> np.ndarray:
    return fall(grow(x, y, depth), new)


def forest(x: np.ndarray, y: np.ndarray, new: np.ndarray, trees: int = 40, depth: int = 6) -> np.ndarray:
    """Mean of trees grown on rows drawn with replacement; the draws are the same for every fit."""
    draw = np.random.default_rng(0)
    total = np.zeros(len(new))
    for _ in range(trees):
        rows = draw.integers(0, len(y), len(y))
        total += fall(grow(x[rows], y[rows], depth), new)
    return total / trees


def boosted(x: np.ndarray, y: np.ndarray, new: np.ndarray, rounds: int = 100, rate: float = 0.1, depth: int = 3) -> np.ndarray:
    """Small trees, each grown on what the ones before leave over."""
    level = float(y.mean())
    left, out = y - level, np.full(len(new), level)
    for _ in range(rounds):
        tree = grow(x, left, depth)
        left = left - rate * fall(tree, x)
        out += rate * fall(tree, new)
    return out


def elastic_net(x: np.ndarray, y: np.ndarray, new: np.ndarray, alpha: float = 1.0, mix: float = 0.5, sweeps: int = 300) -> np.ndarray:
    """Least squares with an absolute (`mix`) and a squared penalty, by coordinate descent."""
    middle, mean = x.mean(axis=0), float(y.mean())
    a, rest = x - middle, y - mean
    size = (a**2).mean(axis=0) + alpha * (1 - mix)
    beta = np.zeros(x.shape[1])
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(size > 0):
            pull = a[:, j] @ rest / len(y) + (size[j] - alpha * (1 - mix)) * beta[j]
            value = np.sign(pull) * max(abs(pull) - alpha * mix, 0.0) / size[j]
            if value != beta[j]:
                rest = rest - a[:, j] * (value - beta[j])
                moved = max(moved, abs(value - beta[j]))
                beta[j] = value
        if moved < 1e-9 * max(1.0, abs(mean)):
            break
    return mean + (new - middle) @ beta


def lasso(x: np.ndarray, y: np.ndarray, new: np.ndarray) -> np.ndarray:
    return elastic_net(x, y, new, mix=1.0)

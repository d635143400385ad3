"""Gradient boosted trees, fitted on a small table of binned features, applied as an expression."""

from __future__ import annotations

import math

import numpy as np

Tree = tuple  # (feature, limit, left, right) or a float


def fit(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 24, depth: int = 3, rate: float = 0.4) -> tuple[float, list[Tree]]:
    """Logistic loss with Newton leaves; rows carry weights (how often they occur)."""
    share = float(np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4))
    base = math.log(share / (1 - share))
    f = np.full(len(y), base)
    trees: list[Tree] = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = w * (y - p), w * p * (1 - p)
        tree = _grow(x, g, h, np.arange(len(y)), depth, rate)
        trees.append(tree)
        f += predict_tree(tree, x)
    return base, trees


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, rate: float) -> Tree:
    gs, hs = g[rows].sum(), h[rows].sum()
    leaf = float(np.clip(gs / (hs + 1.0), -4, 4) * rate)
    if depth == 0 or len(rows) < 2:
        return leaf
    best, cut = 1e-6, None
    for k in range(x.shape[1]):
        order = rows[np.argsort(x[rows, k], kind="stable")]
        v, gc, hc = x[order, k], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
        gain = gc**2 / (hc + 1) + (gs - gc) ** 2 / (hs - hc + 1) - gs**2 / (hs + 1)
        gain[v[:-1] == v[1:]] = -1
        if len(gain) and gain.max() > best:
            i = int(gain.argmax())
            best, cut = gain[i], (k, float(v[i] + v[i + 1]) / 2)
    if cut is None:
        return leaf
    low = x[rows, cut[0]] <= cut[1]
    return (*cut, _grow(x, g, h, rows[low], depth - 1, rate), _grow(x, g, h, rows[~low], depth - 1, rate))


def predict_tree(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    k, limit, low, high = tree
    return np.where(x[:, k] <= limit, predict_tree(low, x), predict_tree(high, x))


def predict(model: tuple[float, list[Tree]], x: np.ndarray) -> np.ndarray:
    return model[0] + sum((predict_tree(t, x) for t in model[1]), np.zeros(len(x)))


def sql(model: tuple[float, list[Tree]], names: list[str]) -> str:
    """The score as SQL over the features."""

    def one(tree: Tree) -> str:
        if not isinstance(tree, tuple):
            return f"{tree!r}D"
        k, limit, low, high = tree
        return f"(CASE WHEN {names[k]} <= {limit!r}D THEN {one(low)} ELSE {one(high)} END)"

    return " + ".join([f"({model[0]!r}D)", *map(one, model[1])])

"""Gradient-boosted regression trees in numpy: squared loss, quantile bins, depth-limited trees."""

from __future__ import annotations

import numpy as np

BINS = 48


def make_bins(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Inner bin borders of each column."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def to_bins(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(b, c, side="right") for b, c in zip(borders, x.T)], axis=1).astype(np.int32)


def _tree(binned: np.ndarray, residual: np.ndarray, depth: int, min_leaf: int, columns: np.ndarray) -> list[tuple]:
    """Nodes (column, bin, left, right, value); leaves have column -1."""
    nodes: list[tuple] = []

    def grow(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        value = float(residual[rows].mean())
        nodes.append((-1, 0, 0, 0, value))
        if level == depth or len(rows) < 2 * min_leaf:
            return me
        width = BINS + 1
        flat = (binned[rows][:, columns] + np.arange(len(columns)) * width).ravel()
        size = np.bincount(flat, minlength=width * len(columns)).reshape(len(columns), width).cumsum(axis=1)
        total = np.bincount(flat, np.repeat(residual[rows], len(columns)), minlength=width * len(columns)).reshape(len(columns), width).cumsum(axis=1)
        n, s = size[:, -1:], total[:, -1:]
        left, right = size, n - size
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = total**2 / left + (s - total) ** 2 / right - s**2 / n
        gain[(left < min_leaf) | (right < min_leaf)] = -np.inf
        best = int(np.argmax(gain))
        if not gain.flat[best] > 1e-9:
            return me
        c, b = int(columns[best // width]), best % width
        low = binned[rows, c] <= b
        a, d = grow(rows[low], level + 1), grow(rows[~low], level + 1)
        nodes[me] = (c, b, a, d, value)
        return me

    grow(np.arange(len(residual)), 0)
    return nodes


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.12, min_leaf: int = 5, seed: int = 9) -> dict:
    rnd = np.random.default_rng(seed)
    borders = make_bins(x)
    binned = to_bins(x, borders)
    base = float(y.mean())
    now = np.full(len(y), base)
    grown = []
    for _ in range(trees):
        columns = np.sort(rnd.permutation(x.shape[1])[: max(2, int(x.shape[1] * 0.6))])
        t = _tree(binned, y - now, depth, min_leaf, columns)
        grown.append(np.array(t, dtype=float))
        now += rate * _apply(binned, grown[-1])
    return {"borders": borders, "base": base, "rate": rate, "trees": grown}


def _apply(binned: np.ndarray, tree: np.ndarray) -> np.ndarray:
    at = np.zeros(len(binned), dtype=np.int64)
    column, border, left, right = (tree[:, i].astype(np.int64) for i in range(4))
    while True:
        live = column[at] >= 0
        if not live.any():
            return tree[at, 4]
        c = np.where(live, column[at], 0)
        low = binned[np.arange(len(binned)), c] <= border[at]
        at = np.where(live, np.where(low, left[at], right[at]), at)


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    binned = to_bins(x, model["borders"])
    out = np.full(len(x), model["base"])
    for t in model["trees"]:
        out += model["rate"] * _apply(binned, t)
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators calibration: knots and levels for np.interp."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        blocks.append([float(s), float(v), 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            b = blocks.pop()
            a = blocks[-1]
            n = a[2] + b[2]
            blocks[-1] = [(a[0] * a[2] + b[0] * b[2]) / n, (a[1] * a[2] + b[1] * b[2]) / n, n]
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])

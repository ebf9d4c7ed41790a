"""Histogram decision trees for bagging and boosting, trained on bounded samples."""

from __future__ import annotations

import numpy as np

BINS = 32


class Tree:
    def __init__(self) -> None:
        self.feature: list[int] = []
        self.cut: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.value: list[float] = []

    def _node(self) -> int:
        for a, x in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            a.append(x)
        return len(self.feature) - 1

    def fit(self, b: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rng, cols: int, least: float = 2.0, lam: float = 1.0) -> Tree:
        """Second-order fit: leaves are -sum(g) / (sum(h) + lam)."""
        stack = [(self._node(), np.arange(len(g)), 0)]
        while stack:
            node, rows, d = stack.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            self.value[node] = -gs / (hs + lam)
            if d >= depth or hs < 2 * least:
                continue
            best = (1e-6, -1, 0)
            for f in rng.choice(b.shape[1], min(cols, b.shape[1]), replace=False):
                x = b[rows, f]
                gl = np.cumsum(np.bincount(x, g[rows], BINS + 1))[:-1]
                hl = np.cumsum(np.bincount(x, h[rows], BINS + 1))[:-1]
                gain = gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam)
                gain[(hl < least) | (hs - hl < least)] = 0
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (gain[i], int(f), i)
            if best[1] < 0 or best[2] >= len(edges[best[1]]):
                continue
            _, f, i = best
            self.feature[node], self.cut[node] = f, float(edges[f][i])
            go = b[rows, f] <= i
            self.left[node], self.right[node] = self._node(), self._node()
            stack += [(self.left[node], rows[go], d + 1), (self.right[node], rows[~go], d + 1)]
        for k in ("feature", "cut", "left", "right", "value"):
            setattr(self, k, np.array(getattr(self, k)))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        rows = np.arange(len(x))
        while (self.feature[at] >= 0).any():
            f = self.feature[at]
            inner = f >= 0
            go = x[rows, np.maximum(f, 0)] <= self.cut[at]
            at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
        return self.value[at]


def _bin(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1), edges


class Bagged:
    """Bagged decision trees; the prediction is the mean of the trees' class shares."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 7, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        b, edges = _bin(x)
        cols = max(2, int(np.ceil(x.shape[1] * 0.5)))
        self.trees = []
        #: Predictions of each row by the trees that weren't trained on it; NaN: all were.
        seen, votes = np.zeros(len(y)), np.zeros(len(y))
        for _ in range(trees):
            w = rng.multinomial(len(y), np.full(len(y), 1 / len(y))).astype(float)
            self.trees.append(Tree().fit(b, edges, -w * y, w, depth, rng, cols, lam=1e-3))
            out = w == 0
            seen[out] += 1
            votes[out] += self.trees[-1].predict(x[out])
        self.out_of_bag = np.where(seen > 0, votes / np.maximum(seen, 1), np.nan)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.clip(sum(t.predict(x) for t in self.trees) / len(self.trees), 0, 1)


class Boosted:
    """Gradient-boosted trees for the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, seed: int = 1, weight: np.ndarray | None = None) -> None:
        rng = np.random.default_rng(seed)
        b, edges = _bin(x)
        w = np.ones(len(y)) if weight is None else weight
        m = float(np.clip((w * y).sum() / w.sum(), 1e-3, 1 - 1e-3))
        self.base, self.rate, self.trees = np.log(m / (1 - m)), rate, []
        s = np.full(len(y), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-s))
            t = Tree().fit(b, edges, w * (p - y), w * p * (1 - p), depth, rng, max(2, int(np.ceil(x.shape[1] * 0.7))), least=1.0)
            self.trees.append(t)
            s += rate * t.predict(x)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum(t.predict(x) for t in self.trees)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))

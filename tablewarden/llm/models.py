"""Small models in numpy: a two-layer network with a temperature, and boosted trees with isotonic steps.

They are fitted on the driver on a bounded sample of labelled rows, and applied in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """tanh layer, then one logit, divided by a temperature that held-back rows choose."""

    hidden: int = 32
    rounds: int = 40
    rate: float = 0.01
    decay: float = 1e-4
    temperature: float = 1.0
    layers: list[np.ndarray] = field(default_factory=list)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Network:
        rng = np.random.default_rng(7)
        own = ~held if held.any() and (~held).any() else np.ones(len(y), bool)
        self.mean, self.scale = x[own].mean(0), x[own].std(0) + 1e-6
        d = x.shape[1]
        self.layers = [rng.normal(0, 1 / np.sqrt(d), (d, self.hidden)), np.zeros(self.hidden), rng.normal(0, 0.1, self.hidden), np.zeros(1)]
        z, t = (x[own] - self.mean) / self.scale, y[own].astype(float)
        weight = np.ones(len(t))
        m = [np.zeros_like(w) for w in self.layers]
        v = [np.zeros_like(w) for w in self.layers]
        step = 0
        for _ in range(self.rounds):
            for at in np.array_split(rng.permutation(len(t)), max(1, len(t) // 256)):
                w1, b1, w2, b2 = self.layers
                h = np.tanh(z[at] @ w1 + b1)
                d2 = (sigmoid(h @ w2 + b2) - t[at]) * weight[at] / len(at)
                dh = d2[:, None] * w2 * (1 - h * h)
                grads = [z[at].T @ dh + self.decay * w1, dh.sum(0), h.T @ d2 + self.decay * w2, d2.sum(keepdims=True)]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.layers[i] = self.layers[i] - self.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        if held.any():
            logit, t = self.logit(x[held]), y[held]
            loss = lambda k: -np.mean(np.log(np.where(t == 1, sigmoid(logit / k), 1 - sigmoid(logit / k)) + 1e-12))
            self.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.temperature)


@dataclass
class Trees:
    """Gradient-boosted trees of logistic loss over binned features, level by level; then isotonic steps on held-back rows."""

    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    ridge: float = 1.0
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, b: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = (1 << (self.depth + 1)) - 1
        feature, split, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.zeros(len(b), int)
        for level in range(self.depth + 1):
            lo = (1 << level) - 1
            for k in range(lo, lo + (1 << level)):
                at = np.flatnonzero(node == k)
                g, h = grad[at].sum(), hess[at].sum()
                value[k] = -g / (h + self.ridge)
                if level == self.depth or len(at) < 20:
                    continue
                best = 1e-6
                for j in range(b.shape[1]):
                    gl = np.bincount(b[at, j], grad[at], self.bins + 1).cumsum()[:-1]
                    hl = np.bincount(b[at, j], hess[at], self.bins + 1).cumsum()[:-1]
                    gain = gl**2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge) - g * g / (h + self.ridge)
                    gain[(hl < 1e-3) | (h - hl < 1e-3)] = 0
                    if gain.max() > best:
                        best, feature[k], split[k] = gain.max(), j, int(gain.argmax())
                if feature[k] >= 0:
                    node[at] = 2 * k + 1 + (b[at, feature[k]] > split[k])
        return feature, split, value

    def _walk(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], b: np.ndarray) -> np.ndarray:
        feature, split, value = tree
        node, rows = np.zeros(len(b), int), np.arange(len(b))
        for _ in range(self.depth):
            j = feature[node]
            node = np.where(j >= 0, 2 * node + 1 + (b[rows, np.maximum(j, 0)] > split[node]), node)
        return value[node]

    def fit(self, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Trees:
        own = ~held if held.any() and (~held).any() else np.ones(len(y), bool)
        t = y[own].astype(float)
        self.edges = [np.unique(np.quantile(x[own, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._bin(x[own])
        rate = np.clip(t.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        f = np.full(len(t), self.base)
        for _ in range(self.trees):
            p = sigmoid(f)
            tree = self._grow(b, p - t, p * (1 - p))
            self.grown.append(tree)
            f += self.rate * self._walk(tree, b)
        if held.any():
            self.steps = isotonic(self.margin(x[held]), y[held].astype(float))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, f = self._bin(x), np.full(len(x), self.base)
        for tree in self.grown:
            f += self.rate * self._walk(tree, b)
        return f

    def score(self, x: np.ndarray) -> np.ndarray:
        f = self.margin(x)
        if self.steps is None:
            return sigmoid(f)
        # between the steps the margin still tells rows apart
        return np.clip(0.98 * np.interp(f, *self.steps) + 0.02 * sigmoid(f), 0, 1)


def isotonic(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (margins, means) to interpolate. Equal margins are one point."""
    points, inverse = np.unique(margin, return_inverse=True)
    total, count = np.bincount(inverse, label), np.bincount(inverse).astype(float)
    pools: list[list[float]] = []
    for x, s, n in zip(points, total, count, strict=True):
        pools.append([x * n, s, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            a = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], a, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])

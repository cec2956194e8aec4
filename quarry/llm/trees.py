"""Decision trees on binned features, in numpy: a random forest and gradient boosting."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """Complete trees of one depth; inner nodes and leaves in breadth-first order."""

    feature: np.ndarray  # (trees, 2^depth - 1)
    limit: np.ndarray  # left if the value is at most this
    leaf: np.ndarray  # (trees, 2^depth)
    base: float

    def sums(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += leaf[at - inner]
        return out


def edges_of(x: np.ndarray) -> list[np.ndarray]:
    """Limits of at most BINS bins a feature, midway between values that occur."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least: float, ridge: float, rng: np.random.RandomState | None, tried: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree that fits -g / (h + ridge), by the gain of that second-order loss; and each row's leaf."""
    n, f = binned.shape
    feature, limit = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    node = np.zeros(n, np.int64)
    for d in range(depth):
        nodes = 2**d
        key = (node[:, None] * f + np.arange(f)) * BINS + binned
        hist = [np.bincount(key.ravel(), np.repeat(v, f), nodes * f * BINS).reshape(nodes, f, BINS) for v in (g, h)]
        gl, hl = (np.cumsum(x, axis=2) for x in hist)
        gs, hs = gl[:, :, -1:], hl[:, :, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
        gain[(hl < least) | (hs - hl < least) | ~np.isfinite(gain)] = -1
        if rng is not None:
            order = np.argsort(rng.rand(nodes, f), axis=1)
            gain[np.arange(nodes)[:, None], order[:, tried:]] = -1
        best = gain.reshape(nodes, -1).argmax(axis=1)
        worth = gain.reshape(nodes, -1).max(axis=1) > 1e-9
        which, cut = best // BINS, best % BINS
        worth &= cut < np.array([len(e) for e in edges])[which]
        first = 2**d - 1
        cuts = np.full(nodes, BINS)
        for k in np.flatnonzero(worth).tolist():
            feature[first + k], limit[first + k], cuts[k] = which[k], edges[which[k]][cut[k]], cut[k]
        node = 2 * node + (binned[np.arange(n), feature[first + node]] > cuts[node])
    gs, hs = np.bincount(node, g, 2**depth), np.bincount(node, h, 2**depth)
    return feature, limit, -gs / np.maximum(hs + ridge, 1e-12), node


def binned_by(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)


def random_forest(x: np.ndarray, y: np.ndarray, trees: int = 100, depth: int = 7, seed: int = 7) -> Forest:
    """Mean of trees on bootstrap rows, the square root of all features tried at each node; sums are probabilities."""
    rng = np.random.RandomState(seed)
    edges = edges_of(x)
    binned = binned_by(x, edges)
    made = []
    for _ in range(trees):
        w = np.bincount(rng.randint(0, len(x), len(x)), minlength=len(x)).astype(float)
        made.append(_tree(binned, edges, -y * w, w, depth, 1.0, 0.0, rng, max(1, round(np.sqrt(x.shape[1])))))
    return Forest(np.stack([m[0] for m in made]), np.stack([m[1] for m in made]), np.stack([m[2] for m in made]) / trees, 0.0)


def boosted(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15) -> Forest:
    """Gradient boosting on the logistic loss; sums are log odds."""
    edges = edges_of(x)
    binned = binned_by(x, edges)
    share = np.clip((w * y).sum() / w.sum(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    score = np.full(len(x), base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        feature, limit, leaf, node = _tree(binned, edges, w * (p - y), w * p * (1 - p), depth, 1e-3 * w.sum() * share, 1.0, None, 0)
        leaf = rate * leaf
        score += leaf[node]
        made.append((feature, limit, leaf))
    return Forest(*(np.stack(m) for m in zip(*made)), base)


def isotonic(score: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising step function from score to probability."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v, k in zip(score[order].tolist(), y[order].tolist(), w[order].tolist()):
        blocks.append([v * k, k, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a, b, _, high = blocks.pop()
            blocks[-1][0] += a
            blocks[-1][1] += b
            blocks[-1][3] = high
    knots = np.array([x for b in blocks for x in (b[2], b[3])])
    values = np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])
    return knots, values

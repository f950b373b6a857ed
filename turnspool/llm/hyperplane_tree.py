"""A multiway hyperplane tree over integer vectors, for searches by inner product.

A node holds a few split points; a vector goes to the nearest. So that inner products and distances
agree, a vector x of squared norm n gets one more coordinate, ``sqrt(M - n)``, M being the largest
squared norm of all, and a query gets a zero there: then ``d(q, x)**2 = |q|**2 + M - 2 q.x``, and
scores from lo to hi are an annulus around q. For every split point the node knows the least and
greatest distance to the vectors of each of its subtrees, also of its siblings'. By the triangle
inequality a subtree can be left out when one split point's range and the query's distance to that
point put all of it inside or outside the annulus.

The tree is small, whatever it indexes: it is fitted on a bounded sample and its ranges are reduced
over all vectors.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Distances are compared with this much slack, as a share of sqrt(M); rounding is below 1e-7.
SLACK = 1e-5
CANDIDATES = 256


class Node(NamedTuple):
    points: np.ndarray  # one row per split point, with the added coordinate
    children: np.ndarray  # a node's number, or -1 - a leaf's


def lifted(vectors: np.ndarray, square: float) -> np.ndarray:
    x = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(square - (x * x).sum(1), 0))
    return np.hstack([x, rest[:, None]])


def distances(x: np.ndarray, points: np.ndarray, square: float) -> np.ndarray:
    """Between lifted vectors, which all lie on a sphere of squared radius ``square``."""
    return np.sqrt(np.maximum(2 * square - 2 * (x @ points.T), 0))


class HyperplaneTree:
    def __init__(self, nodes: list[Node], n_leaves: int, square: float):
        self.nodes, self.n_leaves, self.square = nodes, n_leaves, square
        self.slack = SLACK * np.sqrt(square)
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []

    @classmethod
    def fit(
        cls, sample: np.ndarray, square: float, fanout: int, levels: int, seed: int = 1
    ) -> HyperplaneTree:
        rng = np.random.default_rng(seed)
        x = lifted(sample, square)
        nodes: list[Node] = []
        n_leaves, waiting = 0, [(np.arange(len(x)), 1, None)]
        while waiting:
            own, depth, parent = waiting.pop(0)
            points = split_points(x[own], fanout, rng)
            number = len(nodes)
            nodes.append(Node(points, np.zeros(len(points), np.int64)))
            if parent is not None:
                nodes[parent[0]].children[parent[1]] = number
            nearest = (x[own] @ points.T).argmax(1)
            for k in range(len(points)):
                below = own[nearest == k]
                if depth < levels and len(below) >= 2 * fanout:
                    waiting.append((below, depth + 1, (number, k)))
                else:
                    nodes[number].children[k] = -1 - n_leaves
                    n_leaves += 1
        return cls(nodes, n_leaves, square)

    def leaves(self, vectors: np.ndarray, low: list | None = None, high: list | None = None):
        """The leaf of each vector. ``low`` and ``high`` are narrowed to what was seen."""
        x, leaf = lifted(vectors, self.square), np.zeros(len(vectors), np.int64)
        at = np.zeros(len(x), np.int64)
        for number, (points, children) in enumerate(self.nodes):
            own = np.flatnonzero(at == number)
            if not len(own):
                continue
            far = distances(x[own], points, self.square)
            nearest = (x[own] @ points.T).argmax(1)
            if low is not None:
                order = np.argsort(nearest, kind="stable")
                k, begin = np.unique(nearest[order], return_index=True)
                seen = far[order]
                least, most = (f.reduceat(seen, begin).T for f in (np.minimum, np.maximum))
                low[number][:, k] = np.minimum(low[number][:, k], least)
                high[number][:, k] = np.maximum(high[number][:, k], most)
            next_ = children[nearest]
            at[own] = np.where(next_ >= 0, next_, -1)
            leaf[own] = np.where(next_ < 0, -1 - next_, 0)
        return leaf

    def empty_ranges(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        sizes = [len(n.points) for n in self.nodes]
        return (
            [np.full((m, m), np.inf) for m in sizes],
            [np.full((m, m), -np.inf) for m in sizes],
        )

    def surviving(self, queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """``alive[query, leaf]``: whether the leaf can hold a score from lo to hi."""
        q = queries.astype(np.float64)
        lo, hi = lo.astype(np.float64), hi.astype(np.float64)
        base = (q * q).sum(1) + self.square
        inner = np.sqrt(np.maximum(base - 2 * hi, 0)) - self.slack
        outer = np.sqrt(np.maximum(base - 2 * lo, 0)) + self.slack
        alive = np.zeros((len(q), self.n_leaves), bool)
        open_ = {0: lo <= hi}
        for number, (points, children) in enumerate(self.nodes):
            own = np.flatnonzero(open_.pop(number, np.zeros(0, bool)))
            if not len(own):
                continue
            far = np.sqrt(np.maximum(base[own, None] - 2 * (q[own] @ points[:, :-1].T), 0))
            low, high = self.low[number], self.high[number]  # [split point, subtree]
            nearest = np.maximum(low - far[:, :, None], far[:, :, None] - high).max(1)
            farthest = (far[:, :, None] + high).min(1)
            ok = (nearest <= outer[own, None]) & (farthest >= inner[own, None])
            for k, child in enumerate(children):
                if child < 0:
                    alive[own, -1 - child] = ok[:, k]
                else:
                    open_[int(child)] = np.zeros(len(q), bool)
                    open_[int(child)][own] = ok[:, k]
        return alive


def split_points(x: np.ndarray, fanout: int, rng: np.random.Generator) -> np.ndarray:
    """Points far from each other: each next one is the farthest from those chosen."""
    some = x[rng.permutation(len(x))[:CANDIDATES]]
    chosen, nearness = [0], np.full(len(some), -np.inf)
    while len(chosen) < min(fanout, len(some)):
        nearness = np.maximum(nearness, some @ some[chosen[-1]])
        nearness[chosen] = np.inf
        chosen.append(int(nearness.argmin()))
    return some[chosen]

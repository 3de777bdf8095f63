"""A geometric near-neighbour access tree over integer vectors, searched by inner product.

Each node has several split points; a vector belongs to the child of its nearest one, so children
are cells between hyperplanes. For each split point and each child the node stores the least and
the greatest distance from the point to the child's vectors, and for each child the least and the
greatest squared length. A search wants inner products within a window; with the lengths that is
an annulus of distances around the query, and a child whose possible distances miss the annulus
is left out with all below it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

#: Split points of a node at most, and levels of nodes.
DEGREE, DEPTH = 16, 12


@dataclass
class Node:
    points: np.ndarray
    children: list[int]  # a node's number, or ~leaf
    #: low[i, j], high[i, j]: distances from point i to the vectors of child j.
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)
    #: squared lengths of the vectors of child j.
    shortest: np.ndarray = field(init=False)
    longest: np.ndarray = field(init=False)

    def __post_init__(self):
        size = len(self.points)
        self.low, self.high = np.full((size, size), np.inf), np.full((size, size), -np.inf)
        self.shortest, self.longest = np.full(size, np.inf), np.full(size, -np.inf)


@dataclass
class Tree:
    nodes: list[Node]
    leaves: int

    def route(self, x: np.ndarray, visit: Callable | None = None) -> np.ndarray:
        """Leaf of each vector; ``visit(node number, distances, child)`` sees every step."""
        leaf = np.zeros(len(x), np.int64)
        if not self.nodes or not len(x):
            return leaf
        pending = [(0, np.arange(len(x)))]
        while pending:
            at, rows = pending.pop()
            node = self.nodes[at]
            squares = squared_distances(x[rows], node.points)
            child = squares.argmin(axis=1)  # the first among equals
            if visit:
                visit(at, rows, np.sqrt(squares), child)
            for j, below in enumerate(node.children):
                mine = rows[child == j]
                if below < 0:
                    leaf[mine] = ~below
                elif mine.size:
                    pending.append((below, mine))
        return leaf

    def measure(self, x: np.ndarray) -> None:
        """Widen the stored ranges so that they hold for the vectors ``x`` too."""
        lengths = (x * x).sum(axis=1)

        def visit(at, rows, distances, child):
            node = self.nodes[at]
            for j in np.unique(child):
                mine = distances[child == j]
                node.low[:, j] = np.minimum(node.low[:, j], mine.min(axis=0))
                node.high[:, j] = np.maximum(node.high[:, j], mine.max(axis=0))
                squares = lengths[rows[child == j]]
                node.shortest[j] = min(node.shortest[j], squares.min())
                node.longest[j] = max(node.longest[j], squares.max())

        self.route(x, visit)

    def reach(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[int, np.ndarray]:
        """For each leaf the queries for which it may hold a product within one of their windows.

        ``low`` and ``high`` have a row per query and a column per window; an empty window has
        ``low > high``.
        """
        some = np.flatnonzero((low <= high).any(axis=1))
        if not self.nodes:
            return {0: some} if some.size else {}
        squares = (q * q).sum(axis=1)
        out: dict[int, np.ndarray] = {}
        pending = [(0, some)]
        while pending:
            at, who = pending.pop()
            if not who.size:
                continue
            node = self.nodes[at]
            d = np.sqrt(squared_distances(q[who], node.points))
            for j, below in enumerate(node.children):
                if node.longest[j] < 0:
                    continue  # no vector lies there
                away = np.maximum(d - node.high[:, j], node.low[:, j] - d)
                nearest = np.maximum(away.max(axis=1), 0)
                farthest = (d + node.high[:, j]).min(axis=1)
                # 2 q.x = |q|**2 + |x|**2 - |q - x|**2, and |q.x| <= |q| |x|
                reach = np.sqrt(squares[who] * node.longest[j])
                most = np.minimum((squares[who] + node.longest[j] - nearest**2) / 2, reach)
                least = np.maximum((squares[who] + node.shortest[j] - farthest**2) / 2, -reach)
                # Far above what rounding can lose.
                slack = 1e-9 * (squares[who] + node.longest[j] + farthest**2) + 1e-6
                open_ = (low[who] <= (most + slack)[:, None]) & (high[who] >= (least - slack)[:, None])
                left = who[(open_ & (low[who] <= high[who])).any(axis=1)]
                if below < 0:
                    if left.size:
                        out[~below] = left
                else:
                    pending.append((below, left))
        return out


def squared_distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact for integers whose products sum to less than 2**53."""
    cross = x @ points.T
    return np.maximum((x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None] - 2 * cross, 0)


def _spread(x: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` vectors far from each other: each is the farthest of all from those before."""
    near = squared_distances(x, x[:1])[:, 0]
    chosen = [0]
    while len(chosen) < m and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared_distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def fit(sample: np.ndarray, rows_each: float, leaf_rows: int, degree: int = DEGREE) -> Tree:
    """Tree whose leaves hold about ``leaf_rows`` rows, if each sampled row stands for ``rows_each``.

    A node has as many split points as its rows fill leaves, ``degree`` at most. Rows of the
    sample that can't be told apart stay in one leaf.
    """
    tree = Tree([], 0)

    def grow(members: np.ndarray, depth: int) -> int:
        m = min(degree, int(np.ceil(len(members) * rows_each / leaf_rows)), len(members) // 4)
        # Split points come from few candidates, so that outliers don't take all places.
        points = _spread(sample[members[: 3 * m]], m) if m > 1 and depth < DEPTH else sample[:0]
        if len(points) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        at = len(tree.nodes)
        tree.nodes.append(Node(points, []))
        child = squared_distances(sample[members], points).argmin(axis=1)
        tree.nodes[at].children = [grow(members[child == j], depth + 1) for j in range(len(points))]
        return at

    grow(np.arange(len(sample)), 0)
    return tree

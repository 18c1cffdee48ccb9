"""A multiway hyperplane tree (GNAT) over integer vectors, searched by score windows.

Every node has some split points, and a vector belongs to the nearest of them.
For each split point the node keeps the least and the greatest distance to the
vectors below every one of its siblings (and itself). A search looks for vectors
whose inner product with the query lies in a window. Vectors are lifted to one
common length (one more component), so a window of scores is an annulus of
distances around the query, and a subtree goes when its range of distances to
any split point does not meet the range that the annulus leaves there.

Scores are exact: all numbers stay integers below 2**53 in floating point.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
#: Rows compared with all queries at once.
LEAF = 512


class Vectors:
    """Integer vectors as rows, with squared lengths and the component that lifts them to ``top``."""

    def __init__(self, rows: np.ndarray, top: int) -> None:
        self.rows, self.top = rows, float(top)
        self.squares = np.einsum("ij,ij->i", rows, rows)
        self.lift = np.sqrt(np.maximum(self.top - self.squares, 0))

    def __len__(self) -> int:
        return len(self.rows)

    def take(self, places) -> Vectors:
        out = object.__new__(Vectors)
        out.top = self.top
        out.rows, out.squares, out.lift = self.rows[places], self.squares[places], self.lift[places]
        return out

    def distances(self, points: Vectors) -> np.ndarray:
        """Of the lifted vectors to lifted points."""
        square = self.squares[:, None] + points.squares - 2 * (self.rows @ points.rows.T)
        return np.sqrt(np.maximum(square + (self.lift[:, None] - points.lift) ** 2, 0))


class _Node:
    def __init__(self, points: Vectors) -> None:
        m = len(points)
        self.points = points
        self.children: list[_Node | int] = []
        self.least, self.most = np.full((m, m), np.inf), np.full((m, m), -np.inf)


class Tree:
    """Split points fitted on some vectors; leaves are numbered from 0."""

    def __init__(self, sample: Vectors, leaf: int, fanout: int = FANOUT, seed: int = 7) -> None:
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self.top = sample.top
        self.root = self._grow(sample, leaf, fanout)
        #: Distances are this exact at least, far more than rounding can take away.
        self.slack = 1e-6 * np.sqrt(sample.top) + 1e-9

    def _grow(self, sample: Vectors, leaf: int, fanout: int) -> _Node | int:
        split = self._split(sample, fanout) if len(sample) > leaf else None
        if split is None:
            self.leaves += 1
            return self.leaves - 1
        node = _Node(sample.take(split))
        near = sample.distances(node.points).argmin(axis=1)
        node.children = [self._grow(sample.take(near == j), leaf, fanout) for j in range(len(split))]
        return node

    def _split(self, sample: Vectors, fanout: int) -> np.ndarray | None:
        """Some vectors far from each other; none if all are at one place."""
        some = np.sort(self._random.choice(len(sample), min(len(sample), 6 * fanout), replace=False))
        far = sample.take(some).distances(sample.take(some))
        chosen = [int(far.sum(axis=1).argmax())]
        while len(chosen) < fanout:
            gap = far[:, chosen].min(axis=1)
            if gap.max() <= 0:
                break
            chosen.append(int(gap.argmax()))
        return some[chosen] if len(chosen) > 1 else None

    def nodes(self) -> list[_Node]:
        out, rest = [], [self.root]
        while rest:
            node = rest.pop()
            if isinstance(node, _Node):
                out.append(node)
                rest.extend(node.children)
        return out

    def place(self, rows: Vectors, learn: bool = False) -> np.ndarray:
        """The leaf of each row; ``learn`` widens the nodes' ranges to hold the rows."""
        out = np.zeros(len(rows), np.int32)
        rest = [(self.root, np.arange(len(rows)))]
        while rest:
            node, own = rest.pop()
            if not len(own):
                continue
            if not isinstance(node, _Node):
                out[own] = node
                continue
            far = rows.take(own).distances(node.points)
            near = far.argmin(axis=1)
            for j, child in enumerate(node.children):
                mine = near == j
                if learn and mine.any():
                    np.minimum(node.least[:, j], far[mine].min(axis=0), out=node.least[:, j])
                    np.maximum(node.most[:, j], far[mine].max(axis=0), out=node.most[:, j])
                rest.append((child, own[mine]))
        return out

    def search(self, queries: Vectors, low: np.ndarray, high: np.ndarray):
        """(leaf, queries) for all leaves that may hold a score from low to high.

        The caller may raise ``low`` in place while it goes through the leaves.
        """
        rest = [(self.root, np.flatnonzero(low <= high))]
        while rest:
            node, own = rest.pop()
            if not len(own):
                continue
            if not isinstance(node, _Node):
                yield node, own
                continue
            square = queries.squares[own] + self.top
            score = queries.rows[own] @ node.points.rows.T
            far = np.sqrt(np.maximum(square[:, None] - 2 * score, 0))
            outer = np.sqrt(np.maximum(square - 2 * low[own], 0))[:, None]
            inner = np.sqrt(np.maximum(square - 2 * high[own], 0))[:, None]
            least = np.maximum(far - outer, inner - far) - self.slack
            most = far + outer + self.slack
            for j, child in enumerate(node.children):
                meets = ((node.most[:, j] >= least) & (node.least[:, j] <= most)).all(axis=1)
                rest.append((child, own[meets]))


def best(
    rows: Vectors, keys: np.ndarray, kinds: np.ndarray, queries: Vectors, own_keys: np.ndarray,
    own_kinds: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's k best rows with a score in its window.

    ``same`` asks for rows of the query's own kind, else for all other kinds;
    rows with the query's key never count. Higher scores come first, then lower
    keys. ``low`` is raised in place as better rows are found.
    """
    tree = Tree(rows, LEAF)
    leaf = tree.place(rows, learn=True)
    order = np.argsort(leaf, kind="stable")
    ends = np.cumsum(np.bincount(leaf, minlength=tree.leaves))
    held, size = [], 0

    def kept():
        query, row, score = (np.concatenate(part) for part in zip(*held, strict=True))
        by = np.lexsort((keys[row], -score, query))
        query, row, score = query[by], row[by], score[by]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        full = rank == k - 1
        low[query[full]] = np.maximum(low[query[full]], score[full])
        return query[rank < k], row[rank < k], score[rank < k]

    for number, asked in tree.search(queries, low, high):
        members = order[ends[number - 1] if number else 0 : ends[number]]
        for begin in range(0, len(members), LEAF):
            part = members[begin : begin + LEAF]
            for first in range(0, len(asked), 1 << 12):
                some = asked[first : first + (1 << 12)]
                score = queries.rows[some] @ rows.rows[part].T
                fits = (score >= low[some, None]) & (score <= high[some, None])
                fits &= (own_kinds[some, None] == kinds[part]) == same
                fits &= own_keys[some, None] != keys[part]
                i, j = np.nonzero(fits)
                if len(i):
                    held.append((some[i], part[j], score[i, j]))
                    size += len(i)
                if size > 1 << 20:
                    held = [kept()]
                    size = len(held[0][0])
    if not held:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0)
    return kept()

"""BK-trees over 64-bit fingerprints, built and searched a whole level at a time."""

from __future__ import annotations

import numpy as np

#: Distances of 64-bit fingerprints: 0 to 64.
_KEYS = 65
#: (query, node) pairs looked at together.
FRONTIER = 1 << 21


class Forest:
    """One BK-tree for each group of equal numbers in ``groups``.

    The first member of a group is its tree's root. A node has at most one child
    for every distance; in the child's subtree are all later members at that
    distance from the node.
    """

    def __init__(self, prints: np.ndarray, groups: np.ndarray) -> None:
        self.prints = prints
        self.children = np.full((len(prints), _KEYS), -1, np.int32)
        self.groups, roots, place = np.unique(groups, return_index=True, return_inverse=True)
        self.roots = roots.astype(np.int32)
        node = self.roots[place.ravel()]
        rest = np.flatnonzero(node != np.arange(len(prints)))
        while len(rest):
            parent = node[rest]
            edge = np.bitwise_count(prints[rest] ^ prints[parent]).astype(np.int64)
            keys, first, place = np.unique(parent * np.int64(_KEYS) + edge, return_index=True, return_inverse=True)
            self.children.reshape(-1)[keys] = rest[first]
            node[rest] = rest[first][place.ravel()]
            rest = rest[node[rest] != rest]

    def near(self, prints: np.ndarray, groups: np.ndarray, radius: int):
        """(query, node) places with at most ``radius`` differing bits, some queries at a time.

        Only edges within the radius of a query's distance to the node are
        followed: by the triangle inequality no other subtree can hold a match.
        """
        at = np.minimum(np.searchsorted(self.groups, groups), max(len(self.groups) - 1, 0))
        begin, step = 0, 1024
        while begin < len(prints):
            own = np.arange(begin, min(begin + step, len(prints)))
            own = own[self.groups[at[own]] == groups[own]] if len(self.groups) else own[:0]
            query, node, seen, found = own, self.roots[at[own]], 0, []
            while len(query):
                seen = max(seen, len(query))
                far = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
                hit = far <= radius
                found.append((query[hit], node[hit]))
                following = []
                for more in range(-radius, radius + 1):
                    edge = far + more
                    child = np.where((edge >= 0) & (edge < _KEYS), self.children[node, edge % _KEYS], -1)
                    there = child >= 0
                    following.append((query[there], child[there]))
                query, node = (np.concatenate(part) for part in zip(*following, strict=True))
            if found:
                yield tuple(np.concatenate(part) for part in zip(*found, strict=True))
            begin += step
            # As many queries next as keep the widest level near its bound.
            step = int(min(16_384, max(64, step * FRONTIER / max(seen, 1))))


class Labels:
    """Components of numbers 0 to n - 1 as links arrive, each named by a member."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Links of a spanning forest between the components' names that a and b newly join."""
        out = []
        while True:
            a, b = self.label[a], self.label[b]
            apart = a != b
            if not apart.any():
                return out
            a, b = a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            parent = np.arange(len(self.label))
            np.minimum.at(parent, high, low)
            hooked = np.unique(high)
            out.append((hooked, parent[hooked]))
            while True:
                above = parent[parent]
                if (above == parent).all():
                    break
                parent = above
            self.label = parent[self.label]

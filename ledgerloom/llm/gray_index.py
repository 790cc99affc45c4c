"""An index of 64-bit fingerprints for searches by Hamming distance.

Fingerprints stand in the order of their Gray ranks, in which neighbours differ
in few bits. Groups of neighbours share a pattern of bits; it is factored out
into a node above them, under which the members keep only their other bits, and
so on upwards. A search adds up the differences on the way down, and where
they exceed the radius a whole group is left out.
"""

from __future__ import annotations

import numpy as np

#: Children of a node.
FAN = 16
#: Pairs of query and node that a search holds at once, about.
PAIRS = 1 << 18
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence: every bit becomes the parity of itself and the higher ones."""
    rank = codes.astype(np.uint64)
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(k))
    return rank


class GrayIndex:
    """Over ``codes`` in Gray order; with ``masks``, only those bits of each count (a code then stands for a group)."""

    def __init__(self, codes: np.ndarray, masks: np.ndarray | None = None):
        mask = np.full(len(codes), _ALL) if masks is None else masks
        levels = [(codes & mask, mask)]
        while len(levels[-1][0]) > FAN:
            pattern, mask = levels[-1]
            at = np.arange(0, len(pattern), FAN)
            head = np.repeat(pattern[at], FAN)[: len(pattern)]
            shared = np.bitwise_and.reduceat(mask, at) & ~np.bitwise_or.reduceat(pattern ^ head, at)
            levels.append((pattern[at] & shared, shared))
        #: From the top: each node's pattern and the bits that no node above it has.
        self.levels = [(p, m & ~np.repeat(levels[k + 1][1], FAN)[: len(m)] if k + 1 < len(levels) else m) for k, (p, m) in enumerate(levels)][::-1]

    def _uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """Of each node the label that all codes below it have, or -1."""
        out = [labels]
        for _ in self.levels[1:]:
            at = np.arange(0, len(out[-1]), FAN)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, high, -1))
        return out[::-1]

    def search(self, queries: np.ndarray, radius: int, labels: np.ndarray | None = None, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, code), as positions, of all pairs within the radius; without those whose labels are equal already, if both sides' are given."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        uniform = self._uniform(labels) if labels is not None and own is not None else None
        top = len(self.levels[0][0])
        step = max(1, PAIRS // max(top, 1))
        for begin in range(0, len(queries), step):
            n = min(step, len(queries) - begin)
            self._down(0, np.repeat(np.arange(begin, begin + n), top), np.tile(np.arange(top), n), np.zeros(n * top, dtype=np.uint8), queries, radius, uniform, own, found)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([c for _, c in found])

    def _down(self, level: int, q: np.ndarray, node: np.ndarray, apart: np.ndarray, queries: np.ndarray, radius: int, uniform: list | None, own: np.ndarray | None, found: list) -> None:
        pattern, bits = self.levels[level]
        apart = apart + np.bitwise_count((queries[q] ^ pattern[node]) & bits[node])
        near = apart <= radius
        if uniform is not None:
            near &= uniform[level][node] != own[q]
        q, node, apart = q[near], node[near], apart[near]
        if level + 1 == len(self.levels):
            if len(q):
                found.append((q, node))
            return
        for i in range(0, len(q), PAIRS // FAN):
            part = slice(i, i + PAIRS // FAN)
            below = (node[part, None] * FAN + np.arange(FAN)).ravel()
            there = below < len(self.levels[level + 1][0])
            self._down(level + 1, np.repeat(q[part], FAN)[there], below[there], np.repeat(apart[part], FAN)[there], queries, radius, uniform, own, found)

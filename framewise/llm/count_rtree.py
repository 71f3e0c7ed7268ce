"""R-tree over group-count vectors of sets.

A set's tokens are hashed into groups; its point holds the number of tokens in
each group.  The overlap of two sets is at most the sum over groups of the
smaller count, and for a node that sum with the node's upper corner bounds the
overlap with every set below it.

The bound tells unrelated sets apart as long as a group holds few tokens, so
the number of groups grows with the set.  It is a power of two taken from the
low bits of the hash: the point of a larger set folds to fewer groups by adding
halves, which makes the points of any two sets comparable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 16
#: Fewest groups, and the tokens per group beyond which there are more.
LEAST_GROUPS, PER_GROUP = 64, 6


def groups_for(size: int) -> int:
    """Coordinates of the point of a set of ``size`` tokens."""
    return max(LEAST_GROUPS, 1 << max(0, (-(-size // PER_GROUP) - 1)).bit_length())


def point(hashes: np.ndarray) -> np.ndarray:
    """Counts of the set's token hashes (uint64) in each of its groups."""
    g = groups_for(len(hashes))
    return np.bincount((hashes & np.uint64(g - 1)).astype(np.int64), minlength=g).astype(np.int32)


def fold(p: np.ndarray, groups: int) -> np.ndarray:
    return p.reshape(-1, groups).sum(0)


def _tile_order(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sort-tile order over (size, count of group 0, count of group 1)."""
    m = len(sizes)
    per_axis = max(1, round((m / FAN) ** (1 / 3)))
    order = [np.argsort(sizes, kind="stable")]
    for axis in (0, 1):
        slabs = []
        for part in order:
            for slab in np.array_split(part, per_axis):
                if len(slab):
                    slabs.append(slab[np.argsort(counts[slab, axis % counts.shape[1]], kind="stable")])
        order = slabs
    return np.concatenate(order)


class CountRTree:
    """Bulk-loaded tree; ``counts`` is points x groups, ``sizes`` their sums."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray) -> None:
        self.order = _tile_order(counts, sizes)
        corner, low, high = counts[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(corner, low, high)]  # points first, root level last
        while len(low) > FAN:
            cuts = np.arange(0, len(low), FAN)
            corner = np.maximum.reduceat(corner, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((corner, low, high))

    def candidates(self, count: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Points whose overlap bound allows ``den * |A & B| >= num * |A | B|`` with the given set."""
        alive = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[depth]
            # Sizes first: the smaller set is at least num/den of the larger.
            alive = alive[(den * high[alive] >= num * size) & (den * size >= num * low[alive])]
            bound = np.minimum(corner[alive], count).sum(1)
            alive = alive[(num + den) * bound >= num * (size + low[alive])]
            if depth and len(alive):
                alive = (alive[:, None] * FAN + np.arange(FAN)).ravel()
                alive = alive[alive < len(self.levels[depth - 1][1])]
        return self.order[alive]


def candidate_lists(points: list[np.ndarray], sizes: np.ndarray, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): every pair whose bound allows ``den * |A & B| >= num * |A | B|`` shows up at least once.

    One tree per number of groups: over its own sets and over the larger ones,
    folded, that are near enough in size; its own sets are the queries.
    """
    groups = np.array([len(p) for p in points])
    for g in np.unique(groups):
        own = np.flatnonzero(groups == g)
        larger = np.flatnonzero((groups > g) & (num * sizes <= den * sizes[own].max()))
        ids = np.concatenate((own, larger))
        if len(ids) < 2:
            continue
        counts = np.stack([fold(points[i], g) for i in ids])
        tree = CountRTree(counts, sizes[ids])
        for row, i in enumerate(own):
            near = ids[tree.candidates(counts[row], sizes[i], num, den)]
            yield i, near[near != i]

"""Wu-Manber search for many word sequences at once.

Words take the place of characters.  All patterns of one matcher have the same
length.  A shift table over blocks of consecutive words says how far the search
may jump; a block with shift 0 ends some pattern, and its bucket lists the
patterns to compare directly with the text.
"""

from __future__ import annotations


class WuManber:
    """``patterns``: word tuples of one length, each with the set of its owners."""

    def __init__(self, patterns: dict[tuple, set], block: int = 3) -> None:
        self.length = m = len(next(iter(patterns)))
        self.block = b = min(block, m)
        self.default = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple[list, set]]] = {}
        for p, owners in patterns.items():
            for j in range(m - b + 1):
                key, far = p[j:j + b], m - b - j
                if far < self.shift.get(key, self.default):
                    self.shift[key] = far
            self.buckets.setdefault(p[m - b:], []).append((list(p), owners))

    def occurrences(self, words: list):
        """(start, owners) of every occurrence of every pattern, in order of start."""
        m, b, shift, default, buckets = self.length, self.block, self.shift, self.default, self.buckets
        end, n = m, len(words)
        while end <= n:
            key = tuple(words[end - b:end])
            jump = shift.get(key, default)
            if jump:
                end += jump
                continue
            window = words[end - m:end]
            for pattern, owners in buckets[key]:
                if pattern == window:
                    yield end - m, owners
            end += 1

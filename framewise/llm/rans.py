"""Static range asymmetric numeral system over token ids: one shared table, independent blocks, lanes.

A block holds up to ``BLOCK`` ids.  Id i goes to lane ``i % LANES`` at step
``i // LANES``; a lane is a state in [2**31, 2**63) that gives or takes one
32-bit word when it leaves that range.  The words of all lanes stand in one
stream, by step and lane.  A checkpoint (the lanes' states and the place in the
stream, every ``STEPS`` steps) is a point from which decoding can start, so the
runs between checkpoints are decoded side by side, as are those of all blocks
at hand: every numpy operation works on (runs x lanes) states.
"""

from __future__ import annotations

import numpy as np

LANES = 64
STEPS = 256
BLOCK = 1 << 16
#: Frequencies sum to 2**SCALE.
SCALE = 20

_LEAST = 1 << 31
_SLOT = (1 << SCALE) - 1


class Table:
    """Ids with their shares of 2**SCALE slots; shared by all blocks of a set of files."""

    def __init__(self, ids: np.ndarray, freqs: np.ndarray) -> None:
        self.ids, self.freqs = ids.astype("<u4"), freqs.astype("<u4")
        if int(freqs.sum()) != 1 << SCALE:
            raise ValueError("frequencies do not fill the slots")
        # States are below 2**63, so signed words hold them, and index without a conversion.
        self._f = freqs.astype(np.int64)
        self._c = np.cumsum(self._f) - self._f
        self._slots = np.repeat(np.arange(len(ids)), self._f)
        self._rank = np.full(int(ids.max()) + 1, -1, np.int64)
        self._rank[ids.astype(np.int64)] = np.arange(len(ids))
        #: An id that costs little, to fill up the last step of a block.
        self.filler = int(ids[np.argmax(freqs)])

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        """Shares near the counts', at least one slot an id; what rounding leaves goes to the largest."""
        order = np.argsort(ids)
        ids, counts = np.asarray(ids)[order], np.asarray(counts)[order].astype(np.float64)
        room = 1 << SCALE
        if len(ids) > room // 2:
            raise ValueError(f"{len(ids)} different ids; {room // 2} at most")
        if not len(ids):  # nothing to code: any table will do
            return cls(np.zeros(1, np.int64), np.full(1, room))
        freqs = 1 + np.floor(counts / counts.sum() * (room - len(ids))).astype(np.int64)
        freqs[np.argmax(freqs)] += room - freqs.sum()
        return cls(ids, freqs)

    def to_bytes(self) -> bytes:
        return self.ids.tobytes() + self.freqs.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        both = np.frombuffer(raw, "<u4").astype(np.int64)
        return cls(both[: len(both) // 2], both[len(both) // 2:])

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        found = self._rank[ids.astype(np.int64)]
        if len(found) and found.min() < 0:
            raise ValueError("an id is not in the table")
        return found

    def encode(self, blocks: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Blocks of ids, one a row, all of one multiple of ``LANES``: (words, checkpoint places, checkpoint states)."""
        n, width = blocks.shape
        steps = width // LANES
        symbols = self.ranks(blocks.reshape(-1)).reshape(n, steps, LANES)
        x = np.full((n, LANES), _LEAST)
        words = np.zeros((steps, n, LANES), np.uint32)
        gave = np.zeros((steps, n, LANES), bool)
        marks = {}
        for t in range(steps - 1, -1, -1):
            s = symbols[:, t, :]
            f = self._f[s]
            out = x >> (63 - SCALE) >= f
            gave[t] = out
            words[t] = x  # the low 32 bits
            x = np.where(out, x >> 32, x)
            q = x // f
            x += (q << SCALE) - q * f + self._c[s]
            if t % STEPS == 0:
                marks[t] = x
        runs = sorted(marks)
        places = np.concatenate((np.zeros((1, n), np.int64), np.cumsum(gave.sum(2), axis=0)))
        return ([words[:, b][gave[:, b]] for b in range(n)], [places[runs, b] for b in range(n)],
                [np.stack([marks[t][b] for t in runs]) for b in range(n)])

    def decode(self, words: np.ndarray, places: np.ndarray, states: np.ndarray, steps: np.ndarray) -> list[np.ndarray]:
        """Ids of runs: place in ``words`` and states at each run's start, its number of steps."""
        order = np.argsort(-steps, kind="stable")  # longest first: those still going are a prefix
        x, at = states[order].astype(np.int64), places[order].astype(np.int64)
        left = steps[order]
        out = np.empty((len(order), int(left[0]) if len(order) else 0, LANES), np.uint32)
        padded = np.concatenate((words.astype(np.int64), np.zeros(LANES, np.int64)))
        going = len(order)
        for t in range(out.shape[1]):
            while left[going - 1] <= t:
                going -= 1
            y = x[:going]
            slot = y & _SLOT
            s = self._slots[slot]
            out[:going, t] = s
            y = self._f[s] * (y >> SCALE) + slot - self._c[s]
            take = y < _LEAST
            nth = np.cumsum(take, axis=1)
            x[:going] = np.where(take, (y << 32) | padded[at[:going, None] + nth - take], y)
            at[:going] += nth[:, -1]
        ids = [None] * len(order)
        for row, i in enumerate(order.tolist()):
            ids[i] = self.ids[out[row, : left[row]].reshape(-1)]
        return ids


#: The CRC-32 polynomial of zlib, bits reversed.
_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's, highest power in the lowest bit."""
    out = 0
    for i in range(32):
        if a >> (31 - i) & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, second_size: int) -> int:
    """CRC-32 of two byte strings in a row, from their own and the size of the second."""
    power, square, n = 1 << 31, 1 << 23, second_size  # x**0 and x**8
    while n:
        if n & 1:
            power = _times(square, power)
        square = _times(square, square)
        n >>= 1
    return _times(power, first) ^ second

"""SentencePiece BPE with seeded merge-dropout, and its exact inverse.

Encoding is agenda processing: candidate merges leave a heap by score, then
position, and each may be skipped by a hash keyed with the seed, so that one
text has many reproducible segmentations into pieces of the merge table.
Decoding gives back every text: what the table lacks is spelt in byte pieces.

No piece joins across a space (checked when the table is loaded), so words are
encoded one by one, many words a step.  Every occurrence of a word in a document
has skips of its own.  What the Python worker remembers, while its bounded memory
lasts, is a tree per word: its segmentation after given skips, and the candidates
that it merged since, any of which the next occurrence may skip first.  What is
met once only (most words of a long tail) goes through one agenda with its own
skips and is not remembered.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.common import mix64

SPACE = "▁"
#: Keys that both agendas are held against each other under; occurrences take any of ``_SLOTS`` keys.
VARIANTS = 2
#: Segmentations (of words after given skips) that are remembered, and the length from which a word is not.
REMEMBERED, LONG = 600_000, 48
#: In place of a node: met once, and never met.
_ONCE, _NEW = -1, -2
#: A unit that stands for a literal space mark in a text.
_MARK = ""
#: Characters of texts whose words are segmented together.
TOGETHER = 1 << 20


@dataclass(frozen=True)
class PieceTable:
    """Merge pieces with scores, byte pieces, and the bytes that each id decodes to."""

    merges: dict[str, tuple[float, int]]
    byte_ids: list[int]
    spelt: list[bytes]
    by_words: bool = field(default=True)
    name: int = 0  # checksum of the model file

    @classmethod
    def load(cls, path: str) -> PieceTable:
        """Read a SentencePiece BPE model with byte fallback."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        merges, byte_ids, spelt = {}, [0] * 256, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                spelt.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                spelt.append(b"")
            else:
                merges[piece] = (sp.get_score(i), i)
                spelt.append(piece.replace(SPACE, " ").encode())
        by_words = not any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for p in merges)
        with open(path, "rb") as f:
            return cls(merges, byte_ids, spelt, by_words, zlib.crc32(f.read()))


#: A candidate merge's place in the table of skips: key + left * _LEFT + right * _RIGHT + size * _SIZE.
_LEFT, _RIGHT, _SIZE, _SLOTS = 0xB2B1, 0xD4ED, 0x65B7, 1 << 16


def _skips(alpha: float, seed: int) -> bytes:
    """Per slot, 1 if its hash under ``seed`` falls into the share ``alpha`` of all hashes."""
    slots = np.arange(_SLOTS, dtype=np.uint64) + (np.uint64(seed & 0xFFFFFFFF) << np.uint64(32))
    return (mix64(mix64(slots + np.uint64(1))) < np.uint64(int(alpha * ((1 << 64) - 1)))).astype(np.uint8).tobytes()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices that slices of an array cover, slice by slice."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class _Rows:
    """Rows of unlike length, one after the other in an array that grows."""

    def __init__(self, kind: str) -> None:
        self.spans = np.zeros((2, 1024), np.int64)  # per row: start and length
        self.values = np.zeros(4096, kind)
        self.n = self.filled = 0

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, n: int) -> bytes:
        start, size = self.spans[:, n].tolist()
        return self.values[start:start + size].tobytes()

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers of the new rows."""
        n, end = self.n + len(sizes), self.filled + len(values)
        while n > self.spans.shape[1]:
            self.spans = np.concatenate((self.spans, np.zeros_like(self.spans)), 1)
        while end > len(self.values):
            self.values = np.concatenate((self.values, np.zeros_like(self.values)))
        new = np.arange(self.n, n)
        self.spans[0, new], self.spans[1, new] = self.filled + np.cumsum(sizes) - sizes, sizes
        self.values[self.filled:end] = values
        self.n, self.filled = n, end
        return new

    def cut(self, n: int) -> None:
        """Keep the first ``n`` rows."""
        if n < self.n:
            self.n, self.filled = n, int(self.spans[0, n])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``rows`` one after the other, and how many each has."""
        starts, sizes = self.spans[:, rows]
        return self.values[_spread(starts, sizes)], sizes


@dataclass(frozen=True)
class _Letters:
    """Words as code points, one word after the other."""

    codes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> _Letters:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return cls(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.cumsum(sizes) - sizes, sizes)


class _Merges:
    """The merge table as arrays: symbols are numbered, and pairs of them hashed for look-up."""

    def __init__(self, table: PieceTable) -> None:
        self.symbol = {p: n for n, p in enumerate(table.merges)}
        self.pad = len(self.symbol)
        self.piece = np.array([i for _, i in table.merges.values()], "<i4")
        self.size = np.array([len(p) for p in self.symbol], np.int64)
        # The place of a piece in the order of scores; equal scores share it.
        self.order = np.unique([-score for score, _ in table.merges.values()], return_inverse=True)[1].astype(np.int32)
        pairs = {self.symbol[p[:k]] * (self.pad + 1) + self.symbol[p[k:]]: n for p, n in self.symbol.items()
                 for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol}
        keys, made = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        # Pairs whose slot is taken go to the next table, which hashes them by another factor.
        self.tables: list[tuple[np.int64, np.uint64, np.ndarray, np.ndarray]] = []
        while len(keys):
            factor = mix64(np.array([len(self.tables)], np.uint64)).astype(np.int64)[0] | np.int64(1)
            shift = np.uint64(64 - max(8, (8 * len(keys)).bit_length()))
            slots, first = np.unique((keys * factor).view(np.uint64) >> shift, return_index=True)
            own, into = np.full(1 << (64 - int(shift)), -1, np.int64), np.full(1 << (64 - int(shift)), self.pad, np.int32)
            own[slots], into[slots] = keys[first], made[first]
            self.tables.append((factor, shift, own, into))
            keys, made = np.delete(keys, first), np.delete(made, first)
        chars = [c for c in self.symbol if len(c) == 1]
        self.of_char = np.full(max(map(ord, chars), default=0) + 2, self.pad, np.int32)  # the last one: any higher
        self.of_char[[ord(c) for c in chars]] = [self.symbol[c] for c in chars]

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbols that pairs merge into; ``pad`` where they do not."""
        key = left.astype(np.int64) * (self.pad + 1) + right
        found = np.full(key.shape, self.pad, np.int32)
        for factor, shift, own, into in self.tables:
            at = (key * factor).view(np.uint64) >> shift
            np.copyto(found, into[at], where=own[at] == key)
        return found


class Encoder:
    def __init__(self, table: PieceTable, alpha: float, seed: int) -> None:
        self.table, self.seed = table, seed
        self.skips = _skips(alpha, seed) if alpha else b""
        self.skip = np.frombuffer(self.skips, np.uint8).astype(bool)
        self.merges = _Merges(table)
        self.ids = {p: i for p, (_, i) in table.merges.items()}
        self.byte_ids = np.array(table.byte_ids, "<i4")
        self.spelt = pa.array(table.spelt, pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}   # word -> its node without skips, or _ONCE
        self.after: dict[int, int] = {}   # node << 8 | place of the candidate skipped next -> node, or _ONCE
        self.places = _Rows("<u2")        # per node: its candidates' places in the table of skips, but for the key
        self.made = _Rows("<i4")          # per node: ids; then what the last call of ``_walk`` did not remember

    @property
    def spans(self) -> np.ndarray:
        """Per node: start and number of its candidates in the values of ``places``."""
        return self.places.spans

    def _make_room(self) -> None:
        if len(self.places) > REMEMBERED:
            self._forget()
        if len(self.known) > REMEMBERED:
            self.known = {w: n for w, n in self.known.items() if n != _ONCE}
        if len(self.after) > REMEMBERED:
            self.after = {x: n for x, n in self.after.items() if n != _ONCE}

    def _keys(self, doc: int, n: int) -> np.ndarray:
        """The keys of ``n`` occurrences of words in a document."""
        return self._keys_of([doc], np.array([n]))

    def _keys_of(self, docs: list[int], sizes: np.ndarray) -> np.ndarray:
        """The keys of as many occurrences of words in each document."""
        starts = mix64(np.array([(doc ^ self.seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF for doc in docs], np.uint64))
        nth = _spread(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64)
        return (mix64(np.repeat(starts, sizes) + nth) & np.uint64(_SLOTS - 1)).astype(np.int64)

    def segment(self, unit: str, key: int) -> list[int]:
        """Piece ids of one unit of any length, with a heap as agenda."""
        out: list[int] = []
        for s in self._long(unit, key):
            # A character without a piece: its bytes.
            out.extend([self.ids[s]] if s in self.ids else [self.table.byte_ids[b] for b in s.encode()])
        return out

    def _long(self, unit: str, key: int) -> list[str]:
        """Symbols of one unit, with a heap as agenda."""
        merges, skips = self.table.merges, self.skips
        symbols = list(unit)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple] = []

        def offer(left: int, right: int) -> None:
            both = symbols[left] + symbols[right]
            found = merges.get(both)
            if found:
                heapq.heappush(agenda, (-found[0], left, right, len(both)))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue  # one side has merged with something else meanwhile
            if skips and skips[(key + left * _LEFT + right * _RIGHT + size * _SIZE) % _SLOTS]:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                offer(left, nxt)
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s]

    def _short(self, unit: str, key: int) -> list[str]:
        """The same by the steps of ``segment_many``, for a unit whose characters all have pieces."""
        flat, _ = self._steps(self.merges.of_char[[[ord(c) for c in unit]]], np.array([len(unit)]), np.array([key]))
        left = flat[flat >= 0]
        names = list(self.merges.symbol)
        return [names[n] for n in left.tolist()]

    def segment_many(self, units: list[str], key: int) -> dict[str, bytes]:
        """Unit -> its ids as bytes under ``key``, for units shorter than ``LONG``; the same ids as ``segment``."""
        out: dict[str, bytes] = {}
        for at, ids, sizes, _, _ in self._agendas(_Letters.of(units), np.arange(len(units)), np.full(len(units), key)):
            ends = np.cumsum(sizes).tolist()
            out |= {units[n]: ids[a:b].tobytes() for n, (a, b) in zip(at.tolist(), itertools.pairwise([0, *ends]))}
        return out

    def _agendas(self, letters: _Letters, words: np.ndarray, keys: np.ndarray, most: int | None = None) -> Iterator[tuple]:
        """(which of ``words``, their ids, numbers of ids, places, numbers of places) after at most ``most`` skips each.

        ``words`` are numbers of words in ``letters``.  The places (with
        ``most`` only) are those of the candidates that were merged after these skips.

        Words of about one length go through their agendas together: a step
        takes each word's best candidate and merges or skips it.  A character
        without a piece merges with nothing and is spelt in bytes at the end.
        """
        m = self.merges
        widths = (letters.sizes[words] + 3) // 4
        by_width = np.argsort(widths, kind="stable")
        for at in np.split(by_width, np.flatnonzero(np.diff(widths[by_width])) + 1):
            if not len(at):
                continue
            some, width = words[at], 4 * int(widths[at[0]])
            place = np.minimum(letters.starts[some][:, None] + np.arange(width), len(letters.codes) - 1)
            sizes = letters.sizes[some]
            symbols = m.of_char[np.minimum(letters.codes[place], len(m.of_char) - 1)]
            symbols[np.arange(width) >= sizes[:, None]] = m.pad
            flat, (row, merged) = self._steps(symbols, sizes, keys[at], most)
            kept = np.flatnonzero(flat >= 0)
            left, of = flat[kept], kept // width
            ids, bare = m.piece[np.minimum(left, m.pad - 1)], left == m.pad
            if bare.any():
                chars = letters.codes[place.ravel()[kept[bare]]]
                n = np.ones(len(left), np.int64)
                n[bare] += (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
                raw = chars.astype("<u4").tobytes().decode("utf-32-le").encode()
                ids, of = np.repeat(ids, n), np.repeat(of, n)
                ids[np.repeat(bare, n)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
            yield at, ids, np.bincount(of, minlength=len(at)), merged, np.bincount(row, minlength=len(at))

    def _steps(self, symbols: np.ndarray, sizes: np.ndarray, keys: np.ndarray, most: int | None = None):
        """The agendas of all rows: symbols left over (others: -1), and (row, place) of what was merged.

        With ``most``, a row skips no more after as many skips, and only merges after these are told.
        """
        m = self.merges
        width = symbols.shape[1]
        none = np.int32(np.iinfo(np.int32).max)
        order = np.append(m.order, none)
        # A symbol stands where its first character stood; -1 where it has gone into the one before.
        flat = np.where(np.arange(width) < sizes[:, None], symbols, -1).ravel()
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), len(symbols))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), len(symbols))
        made = np.full(symbols.shape, m.pad, np.int32)  # what a symbol and the one after it merge into
        made[:, :-1] = m.find(symbols[:, :-1], symbols[:, 1:])
        rank = order[made]
        made, flat_rank = made.ravel(), rank.ravel()
        row, spent = np.arange(len(symbols)), np.full(len(symbols), most or 0)
        told: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            at = rank[row].argmin(1)
            left = row * width + at
            open_ = flat_rank[left] < none
            row, at, left = row[open_], at[open_], left[open_]
            if not len(row):
                break
            both, right = made[left], after[left]
            go = slice(None)
            if len(self.skip):
                place = at * _LEFT + right * _RIGHT + m.size[both] * _SIZE
                skip = self.skip[(keys[row] + place) & (_SLOTS - 1)]
                if most is not None:
                    free = spent[row] == 0
                    told.append((row[free], place[free]))
                    skip &= ~free
                    spent[row[skip]] -= 1
                flat_rank[left[skip]] = none
                go = ~skip
            first, here, both = row[go] * width, left[go], both[go]
            gone = first + right[go]
            flat[here], flat[gone], flat_rank[gone], flat_rank[here] = both, -1, none, none
            then = after[here] = after[gone]
            some = then < width
            i, j, new = here[some], first[some] + then[some], both[some]
            before[j] = at[go][some]
            inside = flat[j] >= 0
            i, j, new = i[inside], j[inside], new[inside]
            made[i] = found = m.find(new, flat[j])
            flat_rank[i] = order[found]
            some = before[here] >= 0
            i, new = first[some] + before[here[some]], both[some]
            made[i] = found = m.find(flat[i], new)
            flat_rank[i] = order[found]
        rows, places = map(np.concatenate, zip(*told)) if told else (np.zeros(0, int), np.zeros(0, int))
        by_row = np.argsort(rows, kind="stable")  # in the order of its steps
        return flat, (rows[by_row], (places[by_row] & (_SLOTS - 1)).astype("<u2"))

    def _words(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of ``texts``, the number of each occurrence's unit, and of the occurrences in each text.

        A unit ends before a run of spaces and around a line end.  A literal space
        mark, which must not come back as a space, is a unit of its own.
        """
        parts = [b" " + t.encode() if t else b"" for t in texts]
        raw = b"".join(parts)
        held = np.frombuffer(raw, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        begins = np.zeros(len(held) + 1, bool)
        begins[0], begins[ends] = True, True
        if self.table.by_words:
            line = held == 0x0A
            begins[:-1] |= line
            begins[1:] |= line
            space = held == 0x20
            begins[1:-1] |= space[1:] & ~space[:-1]
        if (mark := SPACE.encode()) in raw:
            at = np.array([m.start() for m in re.finditer(mark, raw)])
            begins[at], begins[at + len(mark)] = True, True
        bounds = np.flatnonzero(begins)
        if len(bounds) < 2:
            return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        units = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)).dictionary_encode()
        words = pc.replace_substring(units.dictionary, " ", SPACE).to_numpy(zero_copy_only=False).tolist()
        if (at := pc.index(units.dictionary, SPACE).as_py()) >= 0:
            words[at] = _MARK
        return words, units.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(bounds, ends), prepend=0)

    def _add(self, letters: _Letters, words: np.ndarray, keys: np.ndarray, most: int | None) -> np.ndarray:
        """New nodes: ``words`` after their first ``most`` skips under ``keys``; with None, all skips, and not remembered."""
        nodes = np.zeros(len(words), np.int64)
        for at, ids, sizes, places, n_places in self._agendas(letters, words, keys, most):
            nodes[at] = self.made.extend(ids, sizes)
            if most is not None:
                self.places.extend(places, n_places)
        return nodes

    def _nodes(self, units: list[str], keys: np.ndarray) -> np.ndarray:
        """The node of each occurrence: the number of its ids in ``made``, until the next call."""
        number = {w: n for n, w in enumerate(dict.fromkeys(units))}
        return self._walk(list(number), np.fromiter(map(number.__getitem__, units), np.int64, len(units)), keys)

    def _walk(self, words: list[str], which: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The node of each occurrence ``which`` of ``words``, as ``_nodes``.

        An occurrence starts at its word's node and goes down by the first
        candidate that its key skips, until it skips none.  A node that only one
        occurrence has wanted so far is not made: the occurrence goes alone.
        """
        self.made.cut(len(self.places))
        letters = _Letters.of(words)
        held = np.fromiter(map(self.known.get, words, itertools.repeat(_NEW)), np.int64, len(words))
        usual = (letters.sizes > 0) & (letters.sizes < LONG)
        again = (held == _ONCE) | (np.bincount(which, minlength=len(words)) > 1)
        first = np.flatnonzero(usual & (held == _NEW) & ~again)
        self.known.update((words[n], _ONCE) for n in first.tolist())
        roots = np.flatnonzero(usual & (held < 0) & again)
        held[roots] = self._add(letters, roots, np.zeros(len(roots), np.int64), 0)
        self.known.update((words[n], node) for n, node in zip(roots.tolist(), held[roots].tolist()))
        nodes = held[which]
        alone = [np.flatnonzero((nodes < 0) & usual[which])]
        open_ = np.flatnonzero(nodes >= 0) if len(self.skip) else np.zeros(0, int)
        short = keys.astype(np.uint16)  # sums of these are modulo _SLOTS
        for depth in range(1, 4 * LONG):
            at = nodes[open_]
            starts, sizes = self.spans[:, at]
            skipped = np.flatnonzero(self.skip[np.repeat(short[open_], sizes) + self.places.values[_spread(starts, sizes)]])
            ends = np.cumsum(sizes)
            of = np.searchsorted(ends, skipped, "right")
            here = np.diff(of, prepend=-1) > 0  # the first of each occurrence
            skipped, of = skipped[here], of[here]
            if not len(of):
                break
            open_ = open_[of]
            steps, some, back, times = np.unique(at[of] << 8 | skipped - ends[of] + sizes[of], return_index=True, return_inverse=True, return_counts=True)
            found = np.fromiter(map(self.after.get, steps.tolist(), itertools.repeat(_NEW)), np.int64, len(steps))
            once = (found == _NEW) & (times == 1)
            self.after.update(dict.fromkeys(steps[once].tolist(), _ONCE))
            lack = np.flatnonzero((found < 0) & ~once)
            ones = open_[some[lack]]
            found[lack] = self._add(letters, which[ones], keys[ones], depth)
            self.after.update(zip(steps[lack].tolist(), found[lack].tolist()))
            nodes[open_] = found[back]
            alone.append(open_[found[back] < 0])
            open_ = open_[found[back] >= 0]
        ones = np.concatenate(alone)
        nodes[ones] = self._add(letters, which[ones], keys[ones], None)
        for n in np.flatnonzero(~usual[which]).tolist():
            ids = self._rare(words[which[n]], int(keys[n]))
            nodes[n] = self.made.extend(ids, np.array([len(ids)]))[0]
        return nodes

    def _rare(self, unit: str, key: int) -> np.ndarray:
        return self.byte_ids[list(SPACE.encode())] if unit == _MARK else np.array(self.segment(unit, key), "<i4")

    def encode_rows(self, texts: list[str | None], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has; a text's key and a word's place in it choose the skips."""
        out, sizes, at = [np.zeros(0, "<i4")], [np.zeros(0, np.int64)], 0
        while at < len(texts):
            held, first = 0, at
            while at < len(texts) and held < TOGETHER:
                held += len(texts[at] or "")
                at += 1
            words, which, n_units = self._words(texts[first:at])
            self._make_room()
            nodes = self._walk(words, which, self._keys_of(keys[first:at], n_units))
            ids, n_ids = self.made.take(nodes)
            sums = np.concatenate(([0], np.cumsum(n_ids)))[np.concatenate(([0], np.cumsum(n_units)))]
            out.append(ids)
            sizes.append(np.diff(sums))
        return np.concatenate(out), np.concatenate(sizes)

    def encode_many(self, texts: list[str | None], keys: list[int]) -> list[np.ndarray | None]:
        """Ids per text, as ``encode_rows``.  None gives None, the empty text no ids."""
        ids, sizes = self.encode_rows(texts, keys)
        ends = itertools.pairwise([0, *np.cumsum(sizes).tolist()])
        return [None if text is None else ids[a:b] for text, (a, b) in zip(texts, ends)]

    def decode_rows(self, ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
        """The bytes of the pieces of each row, whose ids end before ``ends`` (begin with 0)."""
        spelt = self.spelt.take(pa.array(ids))
        _, offsets, raw = spelt.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(ids) + 1)[ends]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(bounds), raw])

    def encode(self, text: str, key: int = 0) -> list[int]:
        """Ids of one text."""
        return self.encode_many([text], [key])[0].tolist()


#: Encoders of this Python worker: its tasks share what they remember.
_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(table: PieceTable, alpha: float, seed: int) -> Encoder:
    key = table.name, alpha, seed
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(table, alpha, seed)
    return _ENCODERS[key]


def decode_ids(table: PieceTable, ids) -> str:
    """The text that was encoded: the bytes of the pieces without the leading space mark (no ids: empty)."""
    raw = b"".join(map(table.spelt.__getitem__, ids))
    return raw.decode("utf-8", "replace")[1:]


def _key(column: str) -> Column:
    return F.xxhash64(F.col(column))


def encode(docs: DataFrame, table: PieceTable, *, text: str = "text", key: str = "doc_id", alpha: float = 0.1,
           seed: int = 1, to: str = "token_ids") -> DataFrame:
    """``docs`` with the array column ``to``: piece ids, the same for the same seed, key and text.

    ``alpha`` is the share of candidate merges that are skipped (0: the plain
    segmentation).  Null texts get null, empty texts an empty array; a null key
    is a key like others; a column named ``to`` is replaced.  No shuffle: the table (the
    vocabulary's size) is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series, keys: pd.Series) -> pd.Series:
        e = _encoder(held.value, alpha, seed)
        return pd.Series(e.encode_many(texts.tolist(), keys.tolist()), dtype=object)

    return docs.withColumn(to, run.asNondeterministic()(F.col(text), _key(key)))


def decode(docs: DataFrame, table: PieceTable, *, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``docs`` with the string column ``to``; null ids give null, no ids the empty text."""
    held = docs.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        t = held.value
        return pd.Series([None if r is None else decode_ids(t, r.tolist()) if len(r) else "" for r in rows], dtype=object)

    return docs.withColumn(to, run.asNondeterministic()(F.col(ids)))


def tokenized(docs: DataFrame, table: PieceTable, **kw) -> DataFrame:
    """One row per document: doc_id, n_tokens, token_ids, lossless (whether decoding gives the text back).

    ``encode`` and ``decode`` of each text in one pass; ``alpha`` and ``seed`` as there.
    """
    alpha, seed = kw.get("alpha", 0.1), kw.get("seed", 1)
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(held.value, alpha, seed)
        for part in _bounded(batches, "text"):
            text = part["text"]
            ids, sizes = e.encode_rows(text.to_pylist(), part["_k"].to_pylist())
            ends = np.concatenate(([0], np.cumsum(sizes)))
            marked = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(" ", text, ""))
            same = pc.fill_null(pc.equal(e.decode_rows(ids, ends), marked.cast(pa.large_binary())), True)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=text.is_null()),
                 same],
                ["doc_id", "n_tokens", "token_ids", "lossless"])

    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("n_tokens", T.LongType()),
                           T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("lossless", T.BooleanType())])
    return docs.select("doc_id", "text", _key("doc_id").alias("_k")).mapInArrow(run, schema)


def _bounded(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of about ``TOGETHER`` bytes of text, so that results stay small."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // TOGETHER
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b > a:
                yield batch.slice(a, b - a)

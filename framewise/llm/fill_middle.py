"""Fill-in-middle transformation: cuts at unit ends, found eight bytes at a time.

A unit is a run of non-space characters with the ASCII white space before it;
white space at the end of a text is a unit of its own.  The UTF-8 bytes of a
batch of texts are viewed as 64-bit words.  Word arithmetic marks the bytes that
end a unit (a carry-free comparison in each byte, the neighbour's mark shifted
in), ``bitwise_count`` counts the marks of each word, a search in the running
counts finds the word that holds the k-th end, and a select within that word
finds its byte.  Code points are counted by the same running counts.

Units end next to ASCII bytes only, so bytes and code points cut alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.common import bounded_parts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are cut together.
TOGETHER = 4 << 20

_EACH = np.uint64(0x0101010101010101)
_HIGH = _EACH * np.uint64(0x80)
_LOW = _EACH * np.uint64(0x7F)
_ONE, _BYTE, _TOP = np.uint64(1), np.uint64(8), np.uint64(56)
_PLACES = np.arange(8, dtype=np.uint64) * _BYTE + np.uint64(7)


def _white(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is 0x20 or 0x09 to 0x0D; sums of 7-bit values never carry over."""
    low = words & _LOW
    other = (low ^ (_EACH * np.uint64(0x20))) + _LOW  # high bit: not a blank
    from_tab = low + _EACH * np.uint64(0x80 - 0x09)  # high bit: 0x09 or above
    past_return = low + _EACH * np.uint64(0x80 - 0x0E)  # high bit: 0x0E or above
    return ((from_tab & ~past_return) | ~other) & ~words & _HIGH


class UnitIndex:
    """Unit ends and code points of many texts, each padded with blanks to whole words (one blank at least)."""

    def __init__(self, texts: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        n_words = self.sizes // 8 + 1
        self.first = np.concatenate(([0], np.cumsum(n_words)))[:-1].astype(np.int64)
        words = np.frombuffer(b"".join(t.ljust(n * 8) for t, n in zip(texts, n_words.tolist())), "<u8")
        white = _white(words)
        following = white >> _BYTE
        following[:-1] |= white[1:] << _TOP
        self.ends = ~white & _HIGH & following
        last = self.sizes - 1
        at = self.first + np.maximum(last, 0) // 8
        shift = ((np.maximum(last, 0) % 8) * 8).astype(np.uint64)
        trailing = (self.sizes > 0) & ((white[at] >> shift) & np.uint64(0x80) > 0)
        self.ends[at[trailing]] |= np.uint64(0x80) << shift[trailing]
        self.starts = ~(words & ~(words << _ONE)) & _HIGH  # bytes that open a code point
        self.n_ends = self._running(self.ends)
        self.n_starts = self._running(self.starts)
        self.n = self.n_ends[self.first + n_words] - self.n_ends[self.first]

    @staticmethod
    def _running(marks: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)))

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Bytes of each text up to the end of its first ``units`` units."""
        nth = self.n_ends[self.first] + units
        word = np.maximum(np.searchsorted(self.n_ends, nth, side="left") - 1, 0)
        rank = nth - self.n_ends[word]
        bits = (self.ends[word][:, None] >> _PLACES) & _ONE
        byte = np.argmax(np.cumsum(bits, axis=1) == rank[:, None].astype(np.uint64), axis=1)
        return np.where(units > 0, (word - self.first) * 8 + byte + 1, 0)

    def code_points(self, size: np.ndarray) -> np.ndarray:
        """Code points in the first ``size`` bytes of each text (a cut never splits one)."""
        word = self.first + size // 8
        below = (_ONE << ((size % 8) * 8).astype(np.uint64)) - _ONE
        inside = np.bitwise_count(self.starts[word] & below)
        return self.n_starts[word] - self.n_starts[self.first] + inside


def _draw(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")


def transform(docs: DataFrame, *, text: str = "text", key: str = "doc_id", seed: int = 42,
              rate: int = 50, spm: int = 80) -> DataFrame:
    """One row per document: ``key``, n, form, prefix_chars, middle_chars, output.

    ``n`` counts the units.  The SHA-256 of ``seed:key`` draws the two cuts,
    whether a text is transformed (``rate`` per cent) and whether its suffix
    comes first (``spm`` per cent; form ``spm``, else ``psm``).  A text that is
    empty, null (taken as empty) or holds one of the three marks stays
    ``plain``, with null counts.  A null key draws like an empty one; rows that
    repeat a key draw alike.  Other columns are ignored whatever their names;
    an empty table gives none.  No shuffle; a task holds some MB of texts.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bounded_parts(batches, "text", TOGETHER):
            texts = [t or b"" for t in part["text"].to_pylist()]
            index = UnitIndex(texts)
            h = [part[f"h{i}"].to_numpy() for i in range(4)]
            one, two = h[0] % (index.n + 1), h[1] % (index.n + 1)
            a, b = index.cut(np.minimum(one, two)), index.cut(np.maximum(one, two))
            chars_a, chars_b = index.code_points(a), index.code_points(b)
            forms, outputs = [], []
            for t, x, y, chosen, back in zip(texts, a.tolist(), b.tolist(), (h[2] % 100 < rate).tolist(),
                                             (h[3] % 100 < spm).tolist()):
                if not t or not chosen or any(m in t for m in marks):
                    forms.append("plain")
                    outputs.append(t)
                elif back:
                    forms.append("spm")
                    outputs.append(b"".join((marks[1], t[y:], marks[0], t[:x], marks[2], t[x:y])))
                else:
                    forms.append("psm")
                    outputs.append(b"".join((marks[0], t[:x], marks[1], t[y:], marks[2], t[x:y])))
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [part["key"], pa.array(index.n, pa.int64()), pa.array(forms, pa.string()),
                 pa.array(chars_a, pa.int64(), mask=plain), pa.array(chars_b - chars_a, pa.int64(), mask=plain),
                 pa.array(outputs, pa.binary()).view(pa.string())], schema.names)

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"),
                       *(_draw(digest, i).alias(f"h{i}") for i in range(4))).mapInArrow(run, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that ``transform`` was given, from its output and form alone.

    A text that holds a mark stays plain, and no mark can arise where two parts
    meet ("<" and ">" stand only at a mark's ends), so the first one found is the right one.
    """
    def parts(mark: str) -> tuple[Column, Column, Column]:
        front = F.split(F.substring(output, 4, (1 << 31) - 1), mark, 2)
        back = F.split(front[1], MIDDLE, 2)
        return front[0], back[0], back[1]

    prefix, suffix, middle = parts(SUFFIX)
    late_suffix, late_prefix, late_middle = parts(PREFIX)
    return (F.when(form == "psm", F.concat(prefix, middle, suffix))
            .when(form == "spm", F.concat(late_prefix, late_middle, late_suffix)).otherwise(output))


def digests(transformed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``transformed`` with SHA-256 digests of the output and of the text restored from it, in place of the output."""
    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    return transformed.select(key, "n", "form", "prefix_chars", "middle_chars",
                              sha(F.col("output")).alias("output_sha256"),
                              sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))

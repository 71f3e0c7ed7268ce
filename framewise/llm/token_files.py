r"""Token ids in files of independent entropy-coded blocks, in ascending document order.

Two tables come first: the ids of every document, and the counts of all ids,
from which one frequency table is made.  The documents are then dealt by ranges
of their ids, and every task writes its range as one or more files.

A file is ``FWTOKEN1``, blocks, an index and a footer.  A block holds the ids of
a row of documents (``rans.Table.encode``), the pieces of documents in it, its
checkpoints and the CRC-32 of its ids, so that any run of blocks can be read
alone.  The index lists the blocks with their CRC-32s; the footer has the
index's place and CRC-32.  Files
count once a table of file names is committed; a task that failed leaves a file
that no such table names.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framewise.llm import rans
from framewise.llm.common import bounded_parts
from framewise.session import materialize, scratch, shared_dir

MAGIC = b"FWTOKEN1"
#: Bytes of text that are tokenized together, words that a worker remembers, blocks that are coded together.
TOGETHER, REMEMBERED, BATCH = 1 << 20, 900_000, 16
#: A file is closed after so many ids or documents.
FILE_IDS, FILE_DOCS = 1 << 24, 1 << 20

#: Ids, pieces, ordinal of the first, does it continue a document, does the last go on, bytes of pieces, checkpoints, words, CRC of the ids.
_HEAD = struct.Struct("<IIqIIIIII")
_FOOT = struct.Struct("<QII8s")  # place of the index, its size, its CRC, magic
_INDEX = np.dtype([("at", "<i8"), ("size", "<i8"), ("n_ids", "<i8"), ("first", "<i8"), ("crc", "<u4")])
_PIECE = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<i8")])


# ---------------------------------------------------------------- tokenizing

class WordEncoder(dict):
    """Ids of words by their UTF-8 bytes, for a tokenizers file; ``encode`` applies it to whole texts.

    For a tokenizer whose pieces never hold or cross ASCII white space a text is
    encoded word by word, and words are remembered (two generations of
    ``REMEMBERED``).  A Latin word goes to the tokenizer's own model directly,
    lower-cased and without the punctuation behind it, where trials show that
    this is what the tokenizer does; any other word goes through all its steps.
    """

    #: Letters of one or two bytes, then punctuation (no apostrophe, which may open an ending, and no "<").
    _PARTS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=-@[-`{-~]*)")
    _TRIALS = ["Straße.", "WORD,", "Été;:", "thwhst", "ÀÖØöÿ!?", "a", "ÆÐÞ...", "Ångström:", "the&&&", 'x)."', "of%%%", "a_"]

    def __init__(self, spec: str, end: int | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(spec)
        self.model = self.tok.model
        #: Ids take two bytes where the vocabulary allows.
        self.kind = "H" if max(self.tok.get_vocab_size(), (end or 0) + 1) <= 1 << 16 else "I"
        self.end = b"" if end is None else struct.pack("<" + self.kind, end)
        self.old: dict[bytes, bytes] = {}
        self.letters = {ord(c): "".join(_byte_sign(b) for b in c.encode()) for c in map(chr, range(0xC0, 0x100))}
        probe = " a b\t\ncd  'll x.y\r\n 12 é "
        self.by_word = self._ids(probe) == b"".join(map(self._ids, probe.split()))
        self.latin = False  # while the trials run
        self.latin = self.by_word and all(self._of_parts(*self._PARTS.fullmatch(w.encode()).groups()) == self._ids(w) for w in self._TRIALS)

    def _ids(self, text: str) -> bytes:
        return array(self.kind, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _of_parts(self, word: bytes, behind: bytes) -> bytes:
        text = word.lower().decode() if word.isascii() else word.decode().lower().translate(self.letters)
        ids = array(self.kind, [t.id for t in self.model.tokenize(text)]).tobytes()
        return ids + self[behind] if behind else ids

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            parts = self._PARTS.fullmatch(word) if self.latin else None
            ids = self._of_parts(*parts.groups()) if parts else self._ids(word.decode("utf-8", "replace"))
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """The ids of a text, with the end id, as words of ``kind``."""
        if self.by_word:
            return b"".join(map(self.__getitem__, text.split())) + self.end  # bytes split at ASCII white space only
        return self._ids(text.decode("utf-8", "replace")) + self.end


def _byte_sign(byte: int) -> str:
    """The character that stands for a byte above 0x7F in byte-level vocabularies.

    Visible characters stand for themselves, the others for U+0100 and on:
    first 0x00 to 0x20 and 0x7F, then 0x80 to 0xA0 and 0xAD.
    """
    hidden = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
    return chr(0x100 + hidden.index(byte)) if byte in hidden else chr(byte)


_ENCODERS: dict[tuple, WordEncoder] = {}


def _encoder(spec: str, end: int | None) -> WordEncoder:
    key = hash(spec), end
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(spec, end)
    return _ENCODERS[key]


def _unpack(packed: bytes, widen: zstandard.ZstdDecompressor) -> np.ndarray:
    """Ids from a table: the size of a word, then the squeezed words."""
    return np.frombuffer(widen.decompress(packed[1:]), f"<u{packed[:1].decode()}")


def token_ids(docs: DataFrame, tokenizer: str, *, text: str = "text", key: str = "doc_id", end: int | None = 2) -> DataFrame:
    """doc_id, tie, n, ids (packed) of every document: all of its text, then ``end``.

    ``tokenizer`` is the content of a tokenizers JSON file, read on the driver
    and broadcast.  A null text counts as empty.  ``tie`` orders rows of one id:
    by the SHA-256 of their text, equal rows in the table's order.
    """
    held = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = _encoder(held.value, end), zstandard.ZstdCompressor(level=1)
        for part in bounded_parts(batches, "text", TOGETHER):
            texts = [t or b"" for t in part["text"].to_pylist()]
            ids = [encoder.encode(t) for t in texts]
            size = struct.calcsize(encoder.kind)
            tie = [hashlib.sha256(t).digest()[:16] + struct.pack(">q", u) for t, u in zip(texts, part["u"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(tie, pa.binary()), pa.array([len(i) // size for i in ids], pa.int64()),
                 pa.array([b"%d" % size + squeeze.compress(i) for i in ids], pa.binary())], ["doc_id", "tie", "n", "ids"])

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"),
                       F.monotonically_increasing_id().alias("u")).mapInArrow(
        run, "doc_id bigint, tie binary, n bigint, ids binary")


def frequency_table(tokens: DataFrame) -> rans.Table:
    """The table of all ids' counts; one row an id reaches the driver, the vocabulary at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widen, total = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for part in (p for batch in batches for p in bounded_parts([batch], "ids", TOGETHER)):
            got = np.bincount(np.concatenate([_unpack(p, widen) for p in part["ids"].to_pylist()]))
            if len(got) > len(total):
                got[: len(total)] += total
                total = got
            else:
                total[: len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counts = tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return rans.Table.of_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))


# ---------------------------------------------------------------- files

def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it."""
    if re.match(r"file:/+", path):
        path = re.sub(r"^file:/+", "/", path)
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


@dataclass
class _Block:
    """Ids and pieces of documents that will be coded together."""

    ordinal: int  # of the first piece's document in the file
    continues: bool  # does the first piece continue a document of the block before?
    ids: list
    pieces: list
    fill: int = 0
    goes_on: bool = False  # does the last piece's document go on in the next block?


class FileWriter:
    """One file: documents go in, blocks go out; ``close`` writes the last block, the index and the footer."""

    def __init__(self, path: str, table: rans.Table) -> None:
        store, where = _store(path)
        if isinstance(store, pafs.LocalFileSystem):
            os.makedirs(os.path.dirname(where), exist_ok=True)
        self.path, self.table = path, table
        self.out = store.open_output_stream(where, compression=None)
        self.at = self.out.write(MAGIC)
        self.squeeze = zstandard.ZstdCompressor(level=3)
        self.index: list[tuple] = []
        self.full: list[_Block] = []
        self.open: _Block | None = None
        self.n_ids = self.n_docs = self.coded = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        done = 0
        while True:
            if self.open is None:
                self.open = _Block(self.n_docs, done > 0, [], [])
            block = self.open
            some = ids[done: done + rans.BLOCK - block.fill]
            block.ids.append(some)
            block.pieces.append((doc_id or 0, doc_id is None, len(some)))
            block.fill += len(some)
            done += len(some)
            if block.fill == rans.BLOCK:
                block.goes_on = done < len(ids)
                self._next()
            if done == len(ids):
                break
        self.n_ids += len(ids)
        self.n_docs += 1

    def _next(self) -> None:
        self.full.append(self.open)
        self.open = None
        if len(self.full) == BATCH:
            self._write(self.full)
            self.full = []

    def _write(self, blocks: list[_Block]) -> None:
        """Code blocks of one length side by side."""
        if not blocks:
            return
        ids = [np.concatenate(b.ids).astype("<u4") for b in blocks]
        width = -(-max(len(ids[0]), 1) // rans.LANES) * rans.LANES
        rows = np.full((len(blocks), width), self.table.filler, "<u4")
        for row, own in zip(rows, ids):
            row[: len(own)] = own
        for block, own, words, places, states in zip(blocks, ids, *self.table.encode(rows)):
            packed = self.squeeze.compress(np.array(block.pieces, _PIECE).tobytes())
            body = b"".join((
                _HEAD.pack(len(own), len(block.pieces), block.ordinal, block.continues, block.goes_on, len(packed),
                           len(places), len(words), zlib.crc32(own.tobytes())),
                packed, places.astype("<u4").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()))
            self.index.append((self.at, len(body), len(own), self.coded, zlib.crc32(body)))
            self.at += self.out.write(body)
            self.coded += len(own)

    def close(self) -> None:
        self._write(self.full)
        self._write([self.open] if self.open else [])
        index = np.array(self.index, _INDEX).tobytes()
        self.out.write(index + _FOOT.pack(self.at, len(index), zlib.crc32(index), MAGIC))
        self.out.close()


@dataclass
class TokenFiles:
    """A committed set of files: their folder, the table of their names, the frequency table."""

    path: str
    files: DataFrame  # part, seq, path, n_docs, n_ids
    table: rans.Table


def write(docs: DataFrame, tokenizer: str, path: str | None = None, *, text: str = "text", key: str = "doc_id",
          end: int | None = 2) -> TokenFiles:
    """Encode every document and write files in ascending order of ``key`` (null first) under ``path``.

    Rows of one id are ordered as ``token_ids`` says; the sort keys are unique,
    so an id that holds a third of all rows is dealt over many files.  Other
    columns are ignored whatever their names.  An empty table gives no file.
    Two shuffle-free passes and one shuffle of packed ids.  ``path`` (default: a
    new folder under the cluster's shared one) is a URI that every executor
    can write.
    """
    spark = docs.sparkSession
    path = (path or shared_dir(spark, "token_files")).rstrip("/")
    with scratch(spark) as kept:
        tokens = materialize(token_ids(docs, tokenizer, text=text, key=key, end=end), "token_ids", kept)
        table = frequency_table(tokens)
        raw = spark.sparkContext.broadcast(table.to_bytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, widen = _table(raw.value), zstandard.ZstdDecompressor()
            part, out, rows = TaskContext.get().partitionId(), None, []
            for batch in batches:
                for doc_id, packed in zip(batch["doc_id"].to_pylist(), batch["ids"]):
                    if out is None:
                        out = FileWriter(f"{path}/part-{part:06d}-{len(rows):05d}-{uuid.uuid4().hex[:12]}.tokens", own)
                    out.add(doc_id, _unpack(packed.as_py(), widen))
                    if out.n_ids >= FILE_IDS or out.n_docs >= FILE_DOCS:
                        rows.append(_closed(out, part, len(rows)))
                        out = None
            if out is not None:
                rows.append(_closed(out, part, len(rows)))
            yield pa.RecordBatch.from_pylist(rows, _FILES)

        ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
        written = ordered.select("doc_id", "ids").mapInArrow(run, "part bigint, seq bigint, path string, n_docs bigint, n_ids bigint")
        written.write.parquet(f"{path}/_files")  # the commit: names of whole files only
        spark.createDataFrame([(bytearray(raw.value),)], "frequencies binary").write.parquet(f"{path}/_table")
    return open_files(spark, path)


_TABLES: dict[int, rans.Table] = {}


def _table(raw: bytes) -> rans.Table:
    """The table of this worker's tasks, made once."""
    key = hash(raw)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = rans.Table.from_bytes(raw)
    return _TABLES[key]


_FILES = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _closed(out: FileWriter, part: int, seq: int) -> dict:
    out.close()
    return {"part": part, "seq": seq, "path": out.path, "n_docs": out.n_docs, "n_ids": out.n_ids}


def open_files(spark: SparkSession, path: str) -> TokenFiles:
    """Files that ``write`` committed under ``path``."""
    raw = bytes(spark.read.parquet(f"{path}/_table").first()["frequencies"])
    return TokenFiles(path, spark.read.parquet(f"{path}/_files"), rans.Table.from_bytes(raw))


# ---------------------------------------------------------------- reading back

def block_runs(tokens: TokenFiles) -> DataFrame:
    """file, path, start (ids before it), at, size: runs of at most ``BATCH`` blocks, from the files' indexes.

    Only footers are read.  ``file`` numbers the files in document order.
    """
    order = W.orderBy("part", "seq")  # one row a file
    files = tokens.files.select(
        "path", (F.row_number().over(order) - 1).cast("bigint").alias("file"),
        F.coalesce(F.sum("n_ids").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"), "n_ids")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for f in frame.itertuples(index=False):
                index = read_index(f.path)
                if int(index["n_ids"].sum()) != f.n_ids:
                    raise ValueError(f"{f.path}: the index does not agree with the table of files")
                for i in range(0, len(index), BATCH):
                    some = index[i: i + BATCH]
                    yield pd.DataFrame({"file": [f.file], "path": [f.path], "start": [f.start + int(some["first"][0])],
                                        "at": [int(some["at"][0])], "size": [int(some["size"].sum())],
                                        "crcs": [some["crc"].astype(np.int64).tolist()]})

    return files.mapInPandas(run, "file bigint, path string, start bigint, at bigint, size bigint, crcs array<bigint>")


def read_index(path: str) -> np.ndarray:
    """The blocks of a file: at, size, n_ids, first, crc."""
    store, where = _store(path)
    with store.open_input_file(where) as f:
        size = f.size()
        at, n, crc, magic = _FOOT.unpack(f.read_at(_FOOT.size, size - _FOOT.size))
        raw = f.read_at(n, at)
        if magic != MAGIC or zlib.crc32(raw) != crc:
            raise ValueError(f"{path}: damaged index")
        return np.frombuffer(raw, _INDEX)


def read_blocks(raw: bytes, crcs: list[int], table: rans.Table) -> Iterator[tuple[_Block, np.ndarray]]:
    """Blocks and ids of a run of blocks; all runs between checkpoints are decoded side by side."""
    at, heads, words, places, states, steps, base = 0, [], [], [], [], [], 0
    widen = zstandard.ZstdDecompressor()
    for crc in crcs:
        head = _HEAD.unpack_from(raw, at)
        n_ids, _, ordinal, continues, goes_on, n_packed, n_marks, n_words, ids_crc = head
        size = _HEAD.size + n_packed + n_marks * (4 + 8 * rans.LANES) + 4 * n_words
        if zlib.crc32(raw[at: at + size]) != crc:
            raise ValueError("damaged block")
        p = at + _HEAD.size
        pieces = np.frombuffer(widen.decompress(raw[p: p + n_packed]), _PIECE)
        p += n_packed
        places.append(np.frombuffer(raw, "<u4", n_marks, p).astype(np.int64) + base)
        p += 4 * n_marks
        states.append(np.frombuffer(raw, "<u8", n_marks * rans.LANES, p).reshape(n_marks, rans.LANES))
        p += 8 * n_marks * rans.LANES
        words.append(np.frombuffer(raw, "<u4", n_words, p))
        total = -(-max(n_ids, 1) // rans.LANES)
        steps += [min(rans.STEPS, total - i * rans.STEPS) for i in range(n_marks)]
        heads.append((_Block(ordinal, bool(continues), [], pieces, n_ids, bool(goes_on)), n_marks, ids_crc))
        base += n_words
        at += size
    runs = table.decode(np.concatenate(words), np.concatenate(places), np.concatenate(states), np.array(steps))
    done = 0
    for block, n_marks, ids_crc in heads:
        ids = np.concatenate(runs[done: done + n_marks])[: block.fill]
        done += n_marks
        if zlib.crc32(ids.tobytes()) != ids_crc:
            raise ValueError("decoded ids do not agree with their checksum")
        yield block, ids


def pieces(tokens: TokenFiles, with_ids: bool = True) -> DataFrame:
    """file, ordinal, doc_id, start, n, crc, ids, whole: what the blocks hold of each document, decoded in parallel.

    ``ids`` are little-endian 32-bit integers (null unless ``with_ids``), ``crc`` is theirs.
    """
    spark = tokens.files.sparkSession
    raw_table = spark.sparkContext.broadcast(tokens.table.to_bytes())
    n_runs = tokens.files.agg(F.sum(F.ceil(F.col("n_ids") / (BATCH * rans.BLOCK)))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(raw_table.value)
        for batch in batches:
            for r in batch.to_pylist():
                store, where = _store(r["path"])
                with store.open_input_file(where) as f:
                    raw = f.read_at(r["size"], r["at"])
                start = r["start"]
                for block, ids in read_blocks(raw, r["crcs"], table):
                    some = block.pieces
                    n = len(some)
                    stop = np.cumsum(some["n"])
                    first = stop - some["n"]
                    view = memoryview(ids.tobytes())
                    parts = [view[4 * a: 4 * b] for a, b in zip(first.tolist(), stop.tolist())]
                    whole = np.ones(n, bool)
                    whole[:1] &= not block.continues
                    whole[-1:] &= not block.goes_on
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, r["file"])), pa.array(block.ordinal + np.arange(n)),
                         pa.array(some["doc_id"].astype(np.int64), mask=some["null"] == 1), pa.array(start + first),
                         pa.array(some["n"].astype(np.int64)), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                         pa.array([bytes(p) if with_ids else None for p in parts], pa.binary()), pa.array(whole)],
                        ["file", "ordinal", "doc_id", "start", "n", "crc", "ids", "whole"])
                    start += block.fill

    tasks = min(n_runs, max(200, 4 * spark.sparkContext.defaultParallelism))
    return block_runs(tokens).repartition(tasks).mapInArrow(
        run, "file bigint, ordinal bigint, doc_id bigint, start bigint, n bigint, crc bigint, ids binary, whole boolean")


def documents(tokens: TokenFiles) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``ids_crc32`` covers the ids as little-endian 32-bit integers; checksums of
    a document that spans blocks are joined without its ids.
    """
    found = materialize(pieces(tokens, with_ids=False).drop("ids"), "token_pieces")

    @F.pandas_udf("bigint")
    def join(parts: pd.Series) -> pd.Series:
        out = []
        for row in parts:
            crc = 0
            for p in sorted(row, key=lambda p: p["start"]):
                crc = rans.joined_crc(crc, p["crc"], 4 * p["n"])
            out.append(crc)
        return pd.Series(out, dtype="int64")

    spread = found.where("NOT whole").groupBy("file", "ordinal").agg(
        F.max("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.collect_list(F.struct("start", "n", "crc")).alias("parts"))
    return found.where("whole").select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")).union(
        spread.select("doc_id", "start", "n_tokens", join("parts").alias("ids_crc32")))

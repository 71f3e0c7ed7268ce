"""Dumps of document collections (BSON files) as a Spark source: ``spark.read.format("bson_dump")``.

A dump is a row of documents, each of which begins with its length and has no
mark between it and the next.  The reader hops from length to length to cut a
file into splits at document ends, so that splits lose and repeat nothing.  A
split decodes the columns that the schema asks for and steps over all others;
filters on top-level fields are tested before the other columns are decoded.
``readStream`` takes the files of a folder in the order of their names.
"""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from framewise.sources.storage import arrow_store, qualified

#: Bytes of a split; rows and bytes of a batch that leaves a task.
SPLIT, ROWS, BYTES = 64 << 20, 4096, 8 << 20

_EPOCH = dt.datetime(1970, 1, 1)
_INT, _LONG, _DOUBLE = struct.Struct("<i"), struct.Struct("<q"), struct.Struct("<d")


# ---------------------------------------------------------------- documents

def _size(kind: int, raw: memoryview, at: int) -> int:
    """Bytes of a value."""
    if kind in (0x01, 0x09, 0x11, 0x12):
        return 8
    if kind in (0x06, 0x0A, 0x7F, 0xFF):
        return 0
    if kind == 0x08:
        return 1
    if kind == 0x10:
        return 4
    if kind == 0x07:
        return 12
    if kind == 0x13:
        return 16
    if kind in (0x02, 0x0D, 0x0E):
        return 4 + _INT.unpack_from(raw, at)[0]
    if kind in (0x03, 0x04, 0x0F):
        return _INT.unpack_from(raw, at)[0]
    if kind == 0x05:
        return 5 + _INT.unpack_from(raw, at)[0]
    if kind == 0x0B:  # pattern and options, each ended by a zero byte
        first = _zero(raw, at)
        return _zero(raw, first + 1) + 1 - at
    raise ValueError(f"unknown type {kind:#x} in a document")


def _zero(raw: memoryview, at: int) -> int:
    while raw[at]:
        at += 1
    return at


def elements(raw: memoryview, at: int = 0) -> Iterator[tuple[str, int, int, int]]:
    """(name, type, place, size) of the values of the document at ``at``."""
    end = at + _INT.unpack_from(raw, at)[0] - 1
    at += 4
    while at < end:
        kind, stop = raw[at], _zero(raw, at + 1)
        name = bytes(raw[at + 1: stop]).decode()
        size = _size(kind, raw, stop + 1)
        yield name, kind, stop + 1, size
        at = stop + 1 + size


def value(raw: memoryview, kind: int, at: int, size: int) -> Any:
    """A value as Python has it: documents as dicts, arrays as lists, object ids as hex, dates without a zone (UTC)."""
    if kind == 0x01:
        return _DOUBLE.unpack_from(raw, at)[0]
    if kind in (0x02, 0x0D, 0x0E):
        return bytes(raw[at + 4: at + size - 1]).decode("utf-8", "replace")
    if kind == 0x03:
        return {n: value(raw, k, a, s) for n, k, a, s in elements(raw, at)}
    if kind == 0x04:
        return [value(raw, k, a, s) for _, k, a, s in elements(raw, at)]
    if kind == 0x05:
        return bytes(raw[at + 5: at + size])
    if kind == 0x07:
        return bytes(raw[at: at + 12]).hex()
    if kind == 0x08:
        return bool(raw[at])
    if kind == 0x09:
        return _EPOCH + dt.timedelta(milliseconds=_LONG.unpack_from(raw, at)[0])
    if kind in (0x06, 0x0A):
        return None
    if kind == 0x10:
        return _INT.unpack_from(raw, at)[0]
    if kind in (0x11, 0x12):
        return _LONG.unpack_from(raw, at)[0]
    raise ValueError(f"values of type {kind:#x} are not read")


def conform(v: Any, to: T.DataType) -> Any:
    """``v`` as the column type; what does not fit is null, as documents of one collection may differ."""
    if v is None:
        return None
    if isinstance(to, T.ArrayType):
        return [conform(x, to.elementType) for x in v] if isinstance(v, list) else None
    if isinstance(to, T.StructType):
        return {f.name: conform(v.get(f.name), f.dataType) for f in to} if isinstance(v, dict) else None
    if isinstance(to, T.StringType):
        return v if isinstance(v, str) else str(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
    if isinstance(to, T.BooleanType):
        return v if isinstance(v, bool) else None
    if isinstance(to, T.BinaryType):
        return v if isinstance(v, bytes) else None
    if isinstance(to, (T.TimestampType, T.TimestampNTZType)):
        if not isinstance(v, dt.datetime):
            return None
        return v.replace(tzinfo=dt.timezone.utc) if isinstance(to, T.TimestampType) else v
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return None
    if isinstance(to, (T.DoubleType, T.FloatType)):
        return float(v)
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}.get(type(to))
    if bits is None:
        raise ValueError(f"no column of type {to.simpleString()} is read from documents")
    return int(v) if v == v and v == int(v) and -(1 << bits - 1) <= v < 1 << bits - 1 else None


def encode(doc: dict) -> bytes:
    """A document of None, bool, int, float, str, bytes, datetime, list and dict values."""
    body = []
    for name, v in doc.items():
        key = name.encode() + b"\0"
        if v is None:
            body.append(b"\x0a" + key)
        elif isinstance(v, bool):
            body.append(b"\x08" + key + bytes([v]))
        elif isinstance(v, int):
            small = -(1 << 31) <= v < 1 << 31
            body.append((b"\x10" if small else b"\x12") + key + (_INT if small else _LONG).pack(v))
        elif isinstance(v, float):
            body.append(b"\x01" + key + _DOUBLE.pack(v))
        elif isinstance(v, str):
            text = v.encode() + b"\0"
            body.append(b"\x02" + key + _INT.pack(len(text)) + text)
        elif isinstance(v, (bytes, bytearray)):
            body.append(b"\x05" + key + _INT.pack(len(v)) + b"\0" + v)
        elif isinstance(v, dt.datetime):
            body.append(b"\x09" + key + _LONG.pack(round((v.replace(tzinfo=None) - _EPOCH).total_seconds() * 1000)))
        elif isinstance(v, (list, tuple)):
            body.append(b"\x04" + key + encode({str(i): x for i, x in enumerate(v)}))
        elif isinstance(v, dict):
            body.append(b"\x03" + key + encode(v))
        else:
            raise TypeError(f"{name}: {type(v).__name__}")
    joined = b"".join(body)
    return _INT.pack(len(joined) + 5) + joined + b"\0"


# ---------------------------------------------------------------- reading

@dataclass
class Split(ds.InputPartition):
    path: str
    start: int
    end: int


def split_file(path: str, size: int) -> list[Split]:
    """Splits of about ``size`` bytes that begin and end between documents."""
    store, where = arrow_store(path)
    out, at, first = [], 0, 0
    with store.open_input_file(where) as f:
        total = f.size()
        window, base = b"", 0
        while at < total:
            if at + 4 > base + len(window):
                window, base = f.read_at(min(1 << 20, total - at), at), at
            length = _INT.unpack_from(window, at - base)[0] if at + 4 <= base + len(window) else 0
            if length < 5 or at + length > total:
                raise ValueError(f"{path}: no document at byte {at}")
            at += length
            if at - first >= size:
                out.append(Split(path, first, at))
                first = at
    return out + ([Split(path, first, total)] if first < total else [])


def _test(f: ds.Filter, v: Any) -> bool:
    """Does ``v`` pass the filter?  Nulls pass none but IsNull."""
    if isinstance(f, ds.IsNull):
        return v is None
    if v is None:
        return False
    if isinstance(f, ds.IsNotNull):
        return True
    if isinstance(f, ds.In):
        return v in f.value
    return {ds.EqualTo: v.__eq__, ds.GreaterThan: v.__gt__, ds.GreaterThanOrEqual: v.__ge__, ds.LessThan: v.__lt__,
            ds.LessThanOrEqual: v.__le__}[type(f)](f.value) is True


_TESTED = (ds.IsNull, ds.IsNotNull, ds.In, ds.EqualTo, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)
_PLAIN = (T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.BooleanType)


class _Reading:
    """What batch and stream readers share."""

    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.schema, self.path = schema, options["path"]
        self.size, self.filters = int(options.get("splitBytes", SPLIT)), []

    def files(self) -> list[str]:
        """The dump, or the ``.bson`` files under the folder, by name."""
        from pyarrow.fs import FileSelector, FileType
        store, where = arrow_store(self.path)
        if store.get_file_info(where).type == FileType.File:
            return [self.path]
        found = [i.path for i in store.get_file_info(FileSelector(where, recursive=True))
                 if i.type == FileType.File and i.path.endswith(".bson") and not i.base_name.startswith(("_", "."))]
        return sorted(self.path.rstrip("/") + p[len(where.rstrip("/")):] for p in found)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        schema = to_arrow_schema(self.schema)
        kinds = {f.name: f.dataType for f in self.schema}
        tests: dict[str, list] = {}
        for f in self.filters:
            tests.setdefault(f.attribute[0], []).append(f)
        store, where = arrow_store(split.path)
        rows: list[dict] = []
        held = 0
        with store.open_input_file(where) as f:
            at = split.start
            while at < split.end:
                # Whole documents, some MB at a time; one that is longer comes alone.
                raw = f.read_at(min(BYTES, split.end - at), at)
                length = _INT.unpack_from(raw)[0]
                if length > len(raw):
                    raw = f.read_at(length, at)
                view, here = memoryview(raw), 0
                while here + 4 <= len(raw) and here + _INT.unpack_from(raw, here)[0] <= len(raw):
                    places = {n: (k, a, s) for n, k, a, s in elements(view, here) if n in kinds}
                    here += _INT.unpack_from(raw, here)[0]
                    row: dict[str, Any] = {}

                    def get(n: str) -> Any:
                        if n not in row:
                            row[n] = conform(value(view, *places[n]), kinds[n]) if n in places else None
                        return row[n]

                    if all(_test(t, get(n)) for n, ts in tests.items() for t in ts):
                        rows.append({n: get(n) for n in kinds})
                        held += sum(s for _, _, s in places.values())
                    if len(rows) >= ROWS or held >= BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                at += here
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


class DumpReader(_Reading, ds.DataSourceReader):
    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            if isinstance(f, _TESTED) and len(f.attribute) == 1 and isinstance(kinds.get(f.attribute[0]), _PLAIN):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Split]:
        return [s for path in self.files() for s in split_file(path, self.size)]


class DumpStreamReader(_Reading, ds.DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": ""}

    def latestOffset(self) -> dict:
        files = self.files()
        return {"last": files[-1].rsplit("/", 1)[-1] if files else ""}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        return [s for path in self.files() if start["last"] < path.rsplit("/", 1)[-1] <= end["last"]
                for s in split_file(path, self.size)]


class BsonDump(ds.DataSource):
    """Options ``path`` (a dump or a folder, qualified with its scheme) and ``splitBytes``; a schema is required."""

    @classmethod
    def name(cls) -> str:
        return "bson_dump"

    def schema(self) -> str:
        raise ValueError("documents have no schema of their own: give one with .schema(...)")

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return DumpReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> ds.DataSourceStreamReader:
        return DumpStreamReader(schema, self.options)


def register(spark: SparkSession) -> None:
    from framewise.session import ship_package
    ship_package(spark).dataSource.register(BsonDump)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan_dump(spark: SparkSession, path: str, schema: T.StructType | str, split_bytes: int = SPLIT) -> DataFrame:
    """Documents of a dump file, or of the ``.bson`` files under a folder; fields that a document lacks are null."""
    register(spark)
    return (spark.read.format("bson_dump").schema(schema).option("path", qualified(spark, path))
            .option("splitBytes", split_bytes).load())


def stream_dump(spark: SparkSession, folder: str, schema: T.StructType | str, split_bytes: int = SPLIT) -> DataFrame:
    """The files of a folder as a stream; a new file's name must come after those that were read."""
    register(spark)
    return (spark.readStream.format("bson_dump").schema(schema).option("path", qualified(spark, folder))
            .option("splitBytes", split_bytes).load())


def write_dump(df: DataFrame, folder: str, mode: str = "overwrite") -> str:
    """Write rows as dump files under ``folder``, some MB each; nulls are left out of a document."""
    from framewise.sources.image_objects import write_objects
    names = df.columns

    def run(batches):
        from pyspark import TaskContext
        part, n, held, docs = TaskContext.get().partitionId(), 0, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                docs.append(encode({k: v for k, v in zip(names, (row[c] for c in names)) if v is not None}))
                held += len(docs[-1])
                if held >= BYTES:
                    yield pa.RecordBatch.from_pydict({"key": [f"part-{part:06d}-{n:06d}.bson"], "content": [b"".join(docs)]})
                    n, held, docs = n + 1, 0, []
        if docs:
            yield pa.RecordBatch.from_pydict({"key": [f"part-{part:06d}-{n:06d}.bson"], "content": [b"".join(docs)]})

    write_objects(df.mapInArrow(run, "key string, content binary"), folder, mode)
    return folder



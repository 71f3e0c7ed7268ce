"""Image files as a Spark sink: ``df.write.format("image_objects")``, one object a row.

Rows are ``key, content``.  A task writes its objects into a staging folder of
its own; the keys appear under their names when the whole write commits, and
not at all when it fails (the staging folder goes away).  A key that is
written twice in one write, or that exists already, holds the new content
afterwards; ``overwrite`` first removes the objects that are there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from framewise.sources.storage import arrow_store, qualified

#: Staged objects are moved by so many threads at once.
MOVERS = 16


@dataclass
class StagedObjects(WriterCommitMessage):
    folder: str
    n: int


class ImageObjects(DataSource):
    """Option ``path``: the folder, qualified with its scheme."""

    @classmethod
    def name(cls) -> str:
        return "image_objects"

    def schema(self) -> str:
        return "key string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ImageObjectWriter(self.options["path"], overwrite)


class ImageObjectWriter(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool) -> None:
        self.root, self.overwrite = root.rstrip("/"), overwrite
        self.staging = f"{self.root}/_staging-{uuid.uuid4().hex[:12]}"
        store, where = arrow_store(self.staging)
        store.create_dir(where, recursive=True)  # here alone: a task that outlives ``abort`` finds no folder to write to

    def write(self, iterator: Iterator[Row]) -> StagedObjects:
        folder, n = f"{self.staging}/{uuid.uuid4().hex[:12]}", 0  # a retried task stages anew
        store, where = arrow_store(folder)
        made: set[str] = set()
        for row in iterator:
            if not row.key or row.key.startswith(("/", "_", ".")) or ".." in row.key.split("/"):
                raise ValueError(f"not a key: {row.key!r}")
            if row.content is None:
                raise ValueError(f"no content: {row.key!r}")
            path = f"{where}/{row.key}"
            if path.rsplit("/", 1)[0] not in made:
                for i in range(len(where), len(path)):
                    if path[i] == "/" and path[:i] not in made:
                        store.create_dir(path[:i], recursive=False)
                        made.add(path[:i])
            with store.open_output_stream(path, compression=None) as out:
                out.write(row.content)
            n += 1
        return StagedObjects(folder, n)

    def _drop(self, folder: str) -> None:
        from pyarrow.fs import FileType
        store, where = arrow_store(folder)
        for last in (False,) * 9 + (True,):
            if store.get_file_info(where).type != FileType.Directory:
                return
            try:
                store.delete_dir(where)
            except OSError:  # a task wrote a file meanwhile
                if last:
                    raise

    def commit(self, messages: list[StagedObjects | None]) -> None:
        from pyarrow.fs import FileSelector, FileType
        store, root = arrow_store(self.root)
        store.create_dir(root, recursive=True)
        if self.overwrite:
            for info in store.get_file_info(FileSelector(root)):
                if not info.base_name.startswith("_"):
                    (store.delete_dir if info.type == FileType.Directory else store.delete_file)(info.path)

        made: set[str] = {root}

        def move(staged: StagedObjects) -> None:
            folder = arrow_store(staged.folder)[1]
            for info in store.get_file_info(FileSelector(folder, recursive=True)):
                if info.type == FileType.File:
                    path = f"{root}/{info.path[len(folder) + 1:]}"
                    if (parent := path.rsplit("/", 1)[0]) not in made:
                        store.create_dir(parent, recursive=True)
                        made.add(parent)
                    store.move(info.path, path)

        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(move, [m for m in messages if m is not None and m.n]))
        self._drop(self.staging)

    def abort(self, messages: list[StagedObjects | None]) -> None:
        self._drop(self.staging)


def write_objects(objects: DataFrame, root: str, mode: str = "append") -> str:
    """Write rows ``key, content`` as objects under ``root``."""
    spark = objects.sparkSession
    register(spark)
    (objects.select("key", "content").write.format("image_objects").mode(mode)
     .option("path", qualified(spark, root)).save())
    return root


def register(spark: SparkSession) -> None:
    from framewise.session import ship_package
    ship_package(spark).dataSource.register(ImageObjects)

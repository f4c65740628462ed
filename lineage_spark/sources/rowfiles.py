"""One file per row: a writer on Spark's Python data source API.

``df.write.format("row_files").mode("append").save(path)`` writes the rows of ``df`` (a string and a binary column: name and
content), each as one file. A task writes into a folder of its own below ``<path>/_temporary``; only when all tasks are
done, the commit gives each of these folders its place (``<path>/part-<partition>-<job>``) by one rename. A
reader never sees a file of a write that is not committed, and what a failed or repeated attempt wrote goes with the temporary folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "row_files"


@dataclass
class Written(WriterCommitMessage):
    folder: str | None
    partition: int
    files: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


class RowFiles(DataSource):
    """The ``row_files`` format; it can only be written."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        kinds = [f.dataType for f in schema.fields]
        if len(kinds) != 2 or not isinstance(kinds[0], T.StringType) or not isinstance(kinds[1], T.BinaryType):
            raise ValueError("row files need a name (string) and a content (binary) column")
        if overwrite:
            raise ValueError("row files are only appended")
        return RowFileWriter(self.options["path"])


class RowFileWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def write(self, iterator: Iterator[T.Row]) -> WriterCommitMessage:
        partition = TaskContext.get().partitionId()
        folder = f"{self.path}/_temporary/{self.job}/{partition:06d}-{uuid.uuid4().hex}"
        store, at = _store(folder)
        seen = set()
        try:
            for name, content in iterator:
                if not name or name in (".", "..") or "/" in name or name in seen:
                    raise ValueError(f"{name!r} cannot name a file, or names two of a partition")
                if not seen:
                    store.create_dir(at, recursive=True)
                seen.add(name)
                with store.open_output_stream(f"{at}/{name}") as out:
                    out.write(bytes(content or b""))
        except BaseException:  # also when the job is cancelled: the abort may have been before this
            if seen:
                store.delete_dir(at)
            raise
        return Written(folder if seen else None, partition, len(seen))

    def commit(self, messages: list[WriterCommitMessage]) -> None:
        for m in messages:
            if m and m.folder:
                store, at = _store(m.folder)
                store.move(at, _store(f"{self.path}/part-{m.partition:06d}-{self.job}")[1])
        self._clean()

    def abort(self, messages: list[WriterCommitMessage]) -> None:
        self._clean()

    def _clean(self) -> None:
        store, at = _store(f"{self.path}/_temporary/{self.job}")
        if store.get_file_info(at).type != fs.FileType.NotFound:
            store.delete_dir(at)
        above = at.rpartition("/")[0]
        if store.get_file_info(above).type != fs.FileType.NotFound and not store.get_file_info(fs.FileSelector(above)):
            store.delete_dir(above)


def save_files(df: DataFrame, path: str, name: str, content: str) -> str:
    """Write ``content`` of every row as a file called ``name`` below ``path``; names are unique in a partition of ``df``.
    Rows of equal names in different partitions lie in different folders. Null content is an empty file."""
    spark = df.sparkSession
    spark.dataSource.register(RowFiles)
    df.select(df[name].alias("name"), df[content].alias("content")).write.format(FORMAT).mode("append").save(path)
    return path

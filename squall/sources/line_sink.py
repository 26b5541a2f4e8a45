"""A streaming sink for lines of text that writes each batch exactly once.

A Python data source (``squall_lines``) with a commit per batch. Every task writes its
lines to a file of its own under ``path/_staged`` and reports its name. When all tasks
of a batch are through, the driver moves the reported files into one folder and renames
that to ``path/batch_id=N``: readers see all of a batch or nothing. What a failed or
doubled attempt has written is not reported, so it is never moved, and goes with the
commit. A batch that is run again after its commit finds its folder and adds nothing.

``path`` is in a folder that the driver and all executors share, of any kind that
``pyarrow.fs`` opens; one query writes to it at a time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

FORMAT = "squall_lines"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    uri = "://" in path or path.startswith("file:")
    return fs.FileSystem.from_uri(path if uri else os.path.abspath(path))


@dataclass
class Staged(WriterCommitMessage):
    """A task's file, None if it had no lines."""

    name: str | None
    lines: int


class LineWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator) -> Staged:
        store, path = _opened(self.path)
        first = next(iterator, None)
        if first is None:
            return Staged(None, 0)
        store.create_dir(f"{path}/_staged", recursive=True)
        name, lines = f"{uuid.uuid4().hex}.txt", 0
        with store.open_output_stream(f"{path}/_staged/{name}") as out:
            row = first
            while row is not None:
                out.write(f"{row[0]}\n".encode())
                lines += 1
                row = next(iterator, None)
        return Staged(name, lines)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        store, path = _opened(self.path)
        names = [m.name for m in messages if m is not None and m.name is not None]
        done, half = f"{path}/batch_id={batchId}", f"{path}/_batch-{batchId}"
        if names and store.get_file_info(done).type == fs.FileType.NotFound:
            if store.get_file_info(half).type != fs.FileType.NotFound:  # a commit that was cut off
                store.delete_dir(half)
            store.create_dir(half, recursive=True)
            for n, name in enumerate(sorted(names)):
                store.move(f"{path}/_staged/{name}", f"{half}/part-{n:05d}.txt")
            store.move(half, done)
        self._clear(store, path)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._clear(*_opened(self.path))

    @staticmethod
    def _clear(store: fs.FileSystem, path: str) -> None:
        # all tasks of the batch have ended, and the next one has not begun
        if store.get_file_info(f"{path}/_staged").type != fs.FileType.NotFound:
            store.delete_dir_contents(f"{path}/_staged")


class LineSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> LineWriter:
        if overwrite:
            raise ValueError("lines are appended")
        if len(schema.fields) != 1 or schema.fields[0].dataType.simpleString() != "string":
            raise ValueError("one string column is written, a line per row")
        if "path" not in self.options:
            raise ValueError("give a path")
        return LineWriter(self.options["path"])


def start_lines(lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write a stream of one string column, a line per row, batch by batch under ``path``."""
    lines.sparkSession.dataSource.register(LineSink)
    writer = lines.writeStream.format(FORMAT).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The committed lines (column ``value``) and their ``batch_id``."""
    store, at = _opened(path.rstrip("/"))
    done = store.get_file_info(at).type != fs.FileType.NotFound and any(
        f.base_name.startswith("batch_id=") for f in store.get_file_info(fs.FileSelector(at))
    )
    if not done:
        return spark.createDataFrame([], "value string, batch_id int")
    return spark.read.text(path)

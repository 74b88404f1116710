"""Lines in numbered shards under one prefix."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from flowkit.sources.messagelog import file_system


@dataclass
class _Written(WriterCommitMessage):
    task: int
    path: str
    lines: int


class _ShardWriter(DataSourceArrowWriter):
    """Tasks write files of their own beside the prefix; only the driver, when all are done, gives them their names."""

    def __init__(self, prefix: str, suffix: str):
        self.prefix, self.suffix = prefix, suffix
        head, _, name = prefix.rpartition("/")
        self.folder = f"{head}/_{name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        # Each attempt has a file of its own: one that fails leaves none that counts.
        path = f"{self.folder}/{task.partitionId()}-{task.taskAttemptId()}"
        system, folder = file_system(self.folder)
        system.create_dir(folder, recursive=True)
        lines = 0
        with system.open_output_stream(file_system(path)[1]) as out:
            for batch in iterator:
                lines += batch.num_rows
                out.write("".join(f"{v or ''}\n" for v in batch.column(0).to_pylist()).encode())
        return _Written(task.partitionId(), path, lines)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = sorted((m for m in messages if m is not None), key=lambda m: m.task)
        # Tasks without rows make no shard, but there is one at least.
        kept = [m for m in done if m.lines] or done[:1]
        system, _ = file_system(self.folder)
        for n, m in enumerate(kept):
            name = f"{self.prefix}-{n:05d}-of-{len(kept):05d}{self.suffix}"
            system.move(file_system(m.path)[1], file_system(name)[1])
        self._clear()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        system, folder = file_system(self.folder)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class NamedShards(DataSource):
    """Options: ``path``, the prefix of the shards, and ``suffix``."""

    @classmethod
    def name(cls) -> str:
        return "named_shards"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _ShardWriter(self.options["path"], self.options.get("suffix", ""))


def write_shards(df: DataFrame, prefix: str, value: Column | str = "value", suffix: str = "") -> None:
    """Write a text column as lines into the files ``prefix-SSSSS-of-NNNNN`` and the suffix.

    One shard per task that has rows, in the order of the tasks, and one empty
    shard if there is no row at all; NULL is an empty line. Files of failed
    attempts never show under the prefix: names are given when every task is
    done. A reader that finds all ``NNNNN`` files has all lines. Shards of an
    earlier run with the same number of files are replaced; others stay. The
    prefix is a path or URI in a file system that every executor reaches.
    """
    df.sparkSession.dataSource.register(NamedShards)
    column = F.col(value) if isinstance(value, str) else value
    lines = df.select(column.cast("string").alias("value"))
    lines.write.format("named_shards").option("path", prefix).option("suffix", suffix).mode("append").save()

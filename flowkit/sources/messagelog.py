"""Messages with attributes in files, as a stream that can be read again from any offset."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from flowkit.functions.times import attribute_time

SCHEMA = "value binary, attributes map<string,string>, published timestamp"
_RUN, _DIGITS, _DONE = "run-", 20, "_SUCCESS"


def file_system(path: str):
    """The file system of a path or URI and the path within it, for use where there is no JVM."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _finished_runs(path: str) -> list[int]:
    """Numbers of the runs that have been written to the end."""
    from pyarrow import fs

    system, folder = file_system(path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    names = [i.base_name for i in found if i.type == fs.FileType.Directory and i.base_name.startswith(_RUN)]
    marks = system.get_file_info([f"{folder}/{n}/{_DONE}" for n in names])
    done = [m.type == fs.FileType.File for m in marks]
    return sorted(int(n.removeprefix(_RUN)) for n, ok in zip(names, done) if ok)


@dataclass
class _File(InputPartition):
    path: str


class _LogReader(DataSourceStreamReader):
    """An offset is the number of the last run that was read.

    A run never changes once it is finished and numbers only grow, so two
    offsets name the same files whenever they are asked for.
    """

    def __init__(self, path: str, after: int):
        self.path, self.after = path, after

    def initialOffset(self) -> dict:
        return {"run": self.after}

    def latestOffset(self) -> dict:
        return {"run": max([self.after, *_finished_runs(self.path)])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        from pyarrow import fs

        system, folder = file_system(self.path)
        found = []
        for run in range(start["run"] + 1, end["run"] + 1):
            inside = system.get_file_info(fs.FileSelector(f"{folder}/{_name(run)}"))
            found += [_File(f"{_name(run)}/{i.base_name}") for i in inside if i.base_name.endswith(".parquet")]
        return sorted(found, key=lambda f: f.path)

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = pa.schema(
            [
                ("value", pa.binary()),
                ("attributes", pa.map_(pa.string(), pa.string())),
                ("published", pa.timestamp("us", "UTC")),
            ]
        )
        system, folder = file_system(self.path)
        with system.open_input_file(f"{folder}/{partition.path}") as file:
            for batch in pq.ParquetFile(file).iter_batches():
                columns = [batch.column(f.name).cast(f.type) for f in kinds]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    def commit(self, end: dict) -> None:
        """Nothing is deleted, so every offset can be read again."""


class MessageLog(DataSource):
    """Options: ``path``, and ``after``, the number of the last run to leave out."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _LogReader(self.options["path"], int(self.options.get("after", "0")))


def _name(run: int) -> str:
    return f"{_RUN}{run:0{_DIGITS}d}"


def publish_messages(
    df: DataFrame, path: str, value: Column, attributes: Mapping[str, Column] | None = None, published: Column | None = None
) -> int:
    """Append messages to a log as its next run, and return the number of the run.

    A run shows when all its files are written. One that failed halfway is
    replaced by the next; a log has one publisher at a time. Attributes are
    text; ``published`` is the time of publishing, now if not given.
    """
    number = max([0, *_finished_runs(path)]) + 1
    pairs = [x for n, c in (attributes or {}).items() for x in (F.lit(n), c.cast("string"))]
    named = F.create_map(*pairs) if pairs else F.create_map()
    when = published if published is not None else F.current_timestamp()
    messages = df.select(
        value.cast("binary").alias("value"),
        named.cast("map<string,string>").alias("attributes"),
        when.cast("timestamp").alias("published"),
    )
    messages.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_name(number)}")
    return number


def read_message_log(spark: SparkSession, path: str, time_attribute: str | None = None, after: int = 0) -> DataFrame:
    """A stream of ``value`` and ``ts`` from a log that ``publish_messages`` wrote.

    ``ts`` is the time of publishing, or what the attribute ``time_attribute``
    says (milliseconds since 1970 or RFC 3339); a message that does not say so
    has NULL. Each file is a partition. A query goes on where its checkpoint
    left off and reads a batch that it had not finished once more, the same
    files. ``after`` leaves out runs up to that number.
    """
    spark.dataSource.register(MessageLog)
    # Without it a query that works off what is there ends before the batch that closes its last windows.
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    messages = spark.readStream.format("message_log").option("path", path).option("after", after).load()
    said = attribute_time(F.col("attributes")[time_attribute]) if time_attribute else F.col("published")
    return messages.select("value", said.alias("ts"))

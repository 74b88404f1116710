"""A stream appended to a declared table, every batch once."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowkit.sinks.files import typed_rows

_STAGED, _SCHEMA, _BATCH = "_staged", "_schema.json", "batch="


class TableFolder:
    """A table in a folder: the schema it was declared with, and one folder for each batch of each writer.

    The names of the batch folders are the ledger. A batch is written beside
    the table and then renamed into it, which is one step; a batch that the
    ledger names is never written again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._paths(f"{self.path}/{name}")

    def declare(self, schema: StructType) -> None:
        """Create the table if there is none; an existing one must have this schema."""
        at = self._at(_SCHEMA)
        if self._system.exists(at):
            known = self.schema()
            if known != schema:
                raise ValueError(f"the table has {known.simpleString()}, not {schema.simpleString()}")
            return
        # Written aside and renamed, so that no half of it is ever read.
        aside = self._at(f"{_STAGED}/schema-{self.spark.sparkContext.applicationId}")
        out = self._system.create(aside, True)
        out.write(bytearray(schema.json().encode()))
        out.close()
        self._system.mkdirs(self._paths(self.path))
        if not self._system.rename(aside, at):
            self.declare(schema)

    def schema(self) -> StructType:
        """The schema that the table was declared with."""
        file = self._system.open(self._at(_SCHEMA))
        try:
            return StructType.fromJson(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")))
        finally:
            file.close()

    def batches(self) -> list[str]:
        """The ledger: names of the batches in the table."""
        if not self._system.exists(self._paths(self.path)):
            return []
        names = [s.getPath().getName() for s in self._system.listStatus(self._paths(self.path))]
        return sorted(n.removeprefix(_BATCH) for n in names if n.startswith(_BATCH))

    def append(self, rows: DataFrame, batch: str, before_commit: Callable[[], None] | None = None) -> bool:
        """Append rows as a batch, unless the table has it already; whether they were appended."""
        final, staged = self._at(_BATCH + batch), self._at(f"{_STAGED}/{batch}")
        if self._system.exists(final):
            # Computed all the same: a stream that repeats the batch has to bring its state up to date.
            rows.write.format("noop").mode("overwrite").save()
            return False
        rows.write.mode("overwrite").parquet(staged.toString())
        if before_commit:
            before_commit()
        if not self._system.rename(staged, final):
            raise RuntimeError(f"batch {batch} could not be moved into {self.path}")
        return True

    def read(self) -> DataFrame:
        """The rows of all batches; a table that was declared and got none is empty."""
        kind = self.schema()
        paths = [f"{self.path}/{_BATCH}{b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*paths)


def start_table_append(
    df: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    writer: str = "stream",
    strict: bool = True,
    available_now: bool = False,
    every: str | None = None,
    before_commit: Callable[[], None] | None = None,
) -> StreamingQuery:
    """Append a stream to the table in a folder, created if there is none, each batch exactly once.

    Columns are put into the order and types of ``schema``; a value that does
    not fit fails the query or, without ``strict``, its row is left out. A
    batch is known by ``writer`` and its number in the checkpoint. If the
    query ends between writing and renaming, the batch is written again; if it
    ends after the rename, before its checkpoint knows, the ledger keeps it
    from being appended twice. Several queries may append to one table under
    different names. ``before_commit`` is called between the two, for tests.
    """
    table = TableFolder(df.sparkSession, path)
    table.declare(schema)

    def append(rows: DataFrame, number: int) -> None:
        typed, _ = typed_rows(rows, schema, strict)
        TableFolder(rows.sparkSession, path).append(typed, f"{writer}-{number:012d}", before_commit)

    started = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(append)
    if available_now:
        started = started.trigger(availableNow=True)
    elif every:
        started = started.trigger(processingTime=every)
    return started.start()


def read_table_folder(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``start_table_append`` writes, those of finished batches only."""
    return TableFolder(spark, path).read()

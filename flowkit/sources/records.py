"""Records of CSV files with line ends inside quotes, read in splits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowkit.session import materialize

# A file is named by two hashes of its path, 128 bits, which are shorter than it.
_SPLIT = ("file", "name", "block")
_LINES_DDL = "file long, name long, block long, row long, inside int, ends int, open0 long, open1 long, value string"
_SPLITS_DDL = "file long, name long, block long, ends int, open0 long, open1 long"


class _Split:
    """Runs through the lines of one split under both states it may start in: outside quotes (0) and inside (1).

    A line of an odd number of quotes changes the state, so the state behind a
    line differs between the two runs by the state at the start alone. It is
    enough to follow the first run, and to know for each the last line that
    began outside.
    """

    def __init__(self, key: tuple[int, int, int]):
        self.key, self.rows, self.state, self.open = key, 0, 0, [-1, -1]

    def take(self, quotes: np.ndarray) -> dict[str, np.ndarray]:
        ends = (np.cumsum(quotes) + self.state) & 1
        inside = np.concatenate([[self.state], ends[:-1]]).astype(np.int32)
        rows = np.arange(self.rows, self.rows + len(quotes))
        begun = [
            np.maximum.accumulate(np.maximum(np.where(inside == state, rows, -1), self.open[state])) for state in (0, 1)
        ]
        self.rows, self.state = self.rows + len(quotes), int(ends[-1])
        self.open = [int(b[-1]) for b in begun]
        return {"row": rows, "inside": inside, "ends": ends.astype(np.int32), "open0": begun[0], "open1": begun[1]}


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Split | None, pa.RecordBatch, dict]]:
    """Stretches of lines of one split with what ``_Split`` says of them; a split comes once more when it is over."""
    split: _Split | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(n).to_numpy() for n in _SPLIT]
        new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        quotes = pc.fill_null(pc.count_substring(batch.column("value"), '"'), 0).to_numpy()
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(int(k[a]) for k in keys)
            if split is None or split.key != key:
                if split is not None:
                    yield split, None, {}
                split = _Split(key)
            yield split, batch.slice(a, b - a), split.take(quotes[a:b])
    if split is not None:
        yield split, None, {}


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, batch, said in _followed(batches):
        if batch is not None:
            columns = {n: batch.column(n) for n in _SPLIT} | {n: pa.array(v) for n, v in said.items()}
            yield pa.RecordBatch.from_pydict(columns | {"value": batch.column("value")})


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for split, batch, _ in _followed(batches):
        if batch is None:
            row = [*split.key, split.state, *split.open]
            names = [*_SPLIT, "ends", "open0", "open1"]
            kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _joined(state: Column, zero: str, one: str) -> Column:
    return F.when(state == 0, F.col(zero)).otherwise(F.col(one))


def read_records(spark: SparkSession, path: str | Sequence[str], skip_header: bool = False) -> DataFrame:
    """One row ``value`` per record of the CSV files that paths or globs name, line ends inside quotes and all.

    Records end at a ``\\n`` outside quotes; one ``\\r`` before it is dropped,
    and so are empty records. A quote opens or closes wherever it stands, and
    a doubled one does both. ``skip_header`` leaves out the first record of
    each file. A quote that is never closed makes one record of the rest of
    its file.

    Files are split over tasks at any line. A first pass counts the quotes of
    each split and says, for either state it may start in, how it ends and
    where its last record begins. Put together in the order of the splits, a
    few bytes each, that gives the state every split really starts in. In the
    second pass a record of one line is passed on as it stands; only the lines
    of longer records are moved, to one row each.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    split = lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.xxhash64(F.lit("name"), "_metadata.file_path").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )
    # One row per split, and all splits of a file in one group: a file of a terabyte has some 8,000.
    splits = materialize(split.mapInArrow(_ends, _SPLITS_DDL), "splits")
    before = Window.partitionBy("file", "name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    state = F.coalesce(F.sum("ends").over(before), F.lit(0)) % 2
    known = splits.withColumn("state", state).withColumn("last", _joined(F.col("state"), "open0", "open1"))
    begun = F.when(F.col("last") >= 0, F.struct(F.col("block").alias("block"), F.col("last").alias("row")))
    known = known.select(*_SPLIT, "state", F.last(begun, True).over(before).alias("carried"))
    known = materialize(known, "states").withColumnsRenamed({n: f"of_{n}" for n in _SPLIT})
    followed = split.mapInArrow(_lines, _LINES_DDL)
    rows = followed.join(known, [F.col(n) == F.col(f"of_{n}") for n in _SPLIT])
    own = _joined(F.col("state"), "open0", "open1")
    begin = F.when(own >= 0, F.struct(F.col("block"), own.alias("row"))).otherwise(F.col("carried"))
    rows = rows.withColumn("begin", begin)
    if skip_header:
        rows = rows.where((F.col("begin.block") > 0) | (F.col("begin.row") > 0))
    whole = (F.col("inside") == F.col("state")) & (F.col("ends") == F.col("state"))
    alone = rows.where(whole).select("value")
    parts = rows.where(~whole).select("file", "name", "begin", F.struct("block", "row", "value").alias("part"))
    texts = F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"])
    together = parts.groupBy("file", "name", "begin").agg(F.array_join(texts, "\n").alias("value")).select("value")
    value = F.col("value")
    cut = F.when(value.endswith("\r"), F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
    return alone.unionByName(together).select(cut.alias("value")).where("value <> ''")

"""CSV in splits, types found in the same pass, shards."""

import csv
import glob
import io
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowkit.sinks import shards
from flowkit.sinks.files import write_csv
from flowkit.sinks.shards import write_shards
from flowkit.sources.files import read_csv, read_lines
from flowkit.sources.records import read_records
from flowkit.sources.types import TYPES, narrowest, with_inferred_types
from tests.conftest import rows
from tests.test_hot import settings_of

FIELD = st.text(alphabet='a,"\n\r é', max_size=6)


def written(values):
    out = io.StringIO(newline="")
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerows(values)
    return out.getvalue()


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(FIELD, FIELD), min_size=1, max_size=30), st.sampled_from([5, 17, 60, 10_000]))
def test_records_at_any_split(spark, tmp_path_factory, values, size):
    folder = tmp_path_factory.mktemp("records")
    for n in range(2):
        (folder / f"{n}.csv").write_text("h,i\n" + written(values), newline="")
    with settings_of(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="0"):
        found = [r.value for r in read_records(spark, f"{folder}/*.csv", skip_header=True).collect()]
    assert sorted(found) == sorted(2 * [written([v])[:-1] for v in values])


def test_a_quote_that_stays_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"open\n2,b\n3,c')
    (tmp_path / "b.csv").write_text("x,y\r\n4,d\r\n\r\n")
    found = [r.value for r in read_records(spark, f"{tmp_path}/*.csv", skip_header=True).collect()]
    assert sorted(found) == ['1,"open\n2,b\n3,c', "4,d"]
    (tmp_path / "c.csv").write_text("")
    assert read_records(spark, f"{tmp_path}/c.csv").collect() == []


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    r = random.Random(1)
    values = [(i, "".join(r.choice('ab",\n') for _ in range(30)), None if i % 7 == 0 else "") for i in range(3000)]
    frame = spark.createDataFrame(values, "i int, a string, b string").coalesce(1)
    write_csv(frame, f"{tmp_path}/x", exact=True)
    with settings_of(spark, spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="0"):
        back = read_csv(spark, f"{tmp_path}/x", "i int, a string, b string", exact=True)
        assert rows(back) == rows(frame)
        lines = spark.read.text(f"{tmp_path}/x").select(F.spark_partition_id().alias("p"))
        assert lines.distinct().count() > 50
    with settings_of(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__files__maxPartitionBytes="4000"):
        assert rows(read_csv(spark, f"{tmp_path}/x", "i int, a string, b string", exact=True)) == rows(frame)


def test_quoted_lines_of_any_writer(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,"n m"\r\n1,"two\r\nlines",3\r\n2,plain,\r\n3,"a ""b"" c",5\r\n', newline="")
    found = read_csv(spark, f"{tmp_path}/a.csv", quoted_lines=True)
    assert found.columns == ["id", "text", "n m"]
    assert rows(found) == [("1", "two\r\nlines", "3"), ("2", "plain", None), ("3", 'a "b" c', "5")]
    typed = read_csv(spark, f"{tmp_path}/a.csv", quoted_lines=True, infer=True)
    assert [t for _, t in typed.dtypes] == ["int", "string", "int"]
    given_types = read_csv(spark, f"{tmp_path}/a.csv", "id bigint, text string, n double", quoted_lines=True)
    assert rows(given_types)[0] == (1, "two\r\nlines", 3.0)


COLUMNS = {
    "int": ["1", "-20", "+3", None, "007"],
    "bigint": ["1", "3000000000", None],
    "double": ["1", "2.5", "-.5", "1e3", "3.", None, "12345678901234567890"],
    "boolean": ["true", "False", None],
    "date": ["2024-02-29", "1999-12-31", None],
    "timestamp": ["2024-02-29", "2024-02-29 10:11:12", "2024-02-29T10:11:12.5Z"],
    "string": ["1", "x", None],
}
TEXT = [["2023-02-29"], [" 1"], ["1 "], [""], ["NaN"], ["1,5"], ["0x10"], ["true", "1"], ["2024-01-01", "5"], [None, None], ["１２"]]


def test_types(spark):
    for want, values in COLUMNS.items():
        frame = spark.createDataFrame([(v, "k") for v in values], "`a b` string, k string")
        assert dict(with_inferred_types(frame).dtypes) == {"a b": want, "k": "string"}, want
    for values in TEXT:
        frame = spark.createDataFrame([(v,) for v in values], "v string")
        assert with_inferred_types(frame).dtypes == [("v", "string")], values
        assert rows(with_inferred_types(frame)) == rows(frame)
    nothing = spark.createDataFrame([], "v string, n int")
    assert with_inferred_types(nothing).dtypes == [("v", "string"), ("n", "int")]
    assert narrowest(None) == "string" and len(TYPES) == 6


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([v for vs in COLUMNS.values() for v in vs]), min_size=1, max_size=4))
def test_a_type_is_one_that_all_values_fit(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    kind = with_inferred_types(frame).dtypes[0][1]
    assert frame.where(F.col("v").isNotNull() & F.col("v").try_cast(kind).isNull()).count() == 0


def test_files_are_read_once_to_find_types(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}.csv").write_text(f"id,price,empty\n{i},{i / 4},\n")
    found = read_csv(spark, f"{tmp_path}/*.csv", infer=True)
    assert found.dtypes == [("id", "int"), ("price", "double"), ("empty", "string")]
    assert found.count() == 100
    # What is left to read is the table that the one pass over the files has written.
    assert all(f.endswith(".parquet") for f in found.inputFiles())


def names(folder):
    return sorted(os.path.basename(f) for f in glob.glob(f"{folder}/*"))


def test_shards_are_named_and_hold_every_line(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 5).select(F.concat(F.lit("é "), F.col("id").cast("string")).alias("value"))
    write_shards(frame, f"{tmp_path}/out/counts", suffix=".txt")
    assert names(f"{tmp_path}/out") == [f"counts-{i:05d}-of-00005.txt" for i in range(5)]
    assert rows(read_lines(spark, f"{tmp_path}/out/counts-*-of-*")) == rows(frame)
    first = (tmp_path / "out" / "counts-00000-of-00005.txt").read_text().split("\n")
    assert first[:2] == ["é 0", "é 1"] and first[-1] == ""


def test_shards_of_few_rows(spark, tmp_path):
    write_shards(spark.range(0, 3, 1, 8).select(F.col("id").cast("string").alias("v")), f"file:{tmp_path}/some", "v")
    assert names(tmp_path) == [f"some-{i:05d}-of-00003" for i in range(3)]
    write_shards(spark.createDataFrame([], "value string"), f"{tmp_path}/none")
    assert (tmp_path / "none-00000-of-00001").read_text() == ""
    write_shards(spark.createDataFrame([(None,), ("x",)], "value string").coalesce(1), f"{tmp_path}/null")
    assert (tmp_path / "null-00000-of-00001").read_text() == "\nx\n"


def test_failed_tasks_leave_no_shard(spark, tmp_path):
    bad = F.when(F.col("id") == 900, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("id").cast("string"))
    with pytest.raises(Exception, match="broken row"):
        write_shards(spark.range(0, 1000, 1, 5).select(bad.alias("value")), f"{tmp_path}/out")
    # Tasks that were still at it may leave a folder of their own, beside the prefix.
    assert [n for n in names(tmp_path) if n.startswith("out")] == []


def test_an_attempt_that_fails_is_not_committed(tmp_path):
    """Of two attempts of a task only the one whose message the driver got is named."""
    writer = shards._ShardWriter(f"{tmp_path}/out", "")
    os.makedirs(writer.folder)
    for attempt, text in ((1, "half"), (2, "whole\n")):
        with open(f"{writer.folder}/0-{attempt}", "w") as file:
            file.write(text)
    writer.commit([shards._Written(0, f"{writer.folder}/0-2", 1), None])
    assert names(tmp_path) == ["out-00000-of-00001"]
    assert (tmp_path / "out-00000-of-00001").read_text() == "whole\n"

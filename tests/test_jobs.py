"""Sources, sinks and whole jobs on files."""

import glob
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowkit.operators import masking
from flowkit.plans import frame_jobs, model_jobs, text_jobs
from flowkit.session import drop_scratch, materialize, scratch_dir
from flowkit.sinks.files import append_table, write_csv
from flowkit.sources.files import group_ids, read_csv, read_csv_list, read_lines, read_table
from tests.conftest import rows


def lines_in(path):
    return sorted(line for f in glob.glob(f"{path}/part-*") for line in open(f, newline="").read().split("\n")[:-1])


def put(folder, name, text):
    (folder / name).write_bytes(text.encode())
    return str(folder / name)


def test_read_lines(spark, tmp_path):
    put(tmp_path, "a.txt", "one\r\n\r\ntwo\rstill two\nlast")
    put(tmp_path, "b.txt", "\nx\n")
    found = [r[0] for r in rows(read_lines(spark, f"{tmp_path}/*.txt"))]
    assert found == sorted(["one", "", "two\rstill two", "last", "", "x"], key=lambda v: repr((v,)))


def test_read_lines_without_headers(spark, tmp_path):
    odd = ["\\x", "a\\,b", " lead", "trail ", "#c", '"q', "\tt", "a\x01b", "é", '""', "null", "x\\"]
    for i in range(3):
        put(tmp_path, f"{i}.csv", f'id,"name"\r\n{i},"a, ""b"""\r\n{i},\'x\n' + "\n".join([*odd, "", " "]))
    found = [r[0] for r in rows(read_lines(spark, f"{tmp_path}/*.csv", skip_header=True))]
    expected = [f'{i},"a, ""b"""' for i in range(3)] + [f"{i},'x" for i in range(3)] + [*odd, "", " "] * 3
    assert sorted(found) == sorted(expected)


def test_word_count_job(spark, tmp_path):
    source = put(tmp_path, "in.txt", "a b c a b a\nacento gráfico\nJuly 30, 2018\n\n aa bb cc aa bb aa")
    text_jobs.run_word_count(spark, source + "*", f"{tmp_path}/out")
    assert lines_in(f"{tmp_path}/out") == sorted(
        ["a: 3", "b: 2", "c: 1", "acento: 1", "gráfico: 1", "July: 1", "30: 1", "2018: 1", "aa: 3", "bb: 2", "cc: 1"]
    )


def test_split_job(spark, tmp_path):
    source = put(tmp_path, "in.txt", "A whole new world\nA new fantastic point of view")
    text_jobs.run_split_words(spark, source, f"{tmp_path}/out")
    assert lines_in(f"{tmp_path}/out-chars") == ["46"]
    assert lines_in(f"{tmp_path}/out-short-words") == ["A: 2", "new: 2", "of: 1"]
    assert lines_in(f"{tmp_path}/out-words") == ["fantastic: 1", "point: 1", "view: 1", "whole: 1", "world: 1"]


@pytest.mark.parametrize("factor", [1, 2])
def test_count_job(spark, tmp_path, factor):
    source = put(tmp_path, "in.txt", "x\ny, z\nx\n  x\n\ttab\ntab\n\n\\N\na\rb\n")
    text_jobs.run_count_lines(spark, source, f"{tmp_path}/out", factor)
    found = read_csv(spark, f"{tmp_path}/out", "value string, n bigint", exact=True)
    once = ["y, z", "  x", "\ttab", "tab", "", "\\N", "a\rb"]
    assert rows(found) == sorted([("x", 2 * factor), *[(v, factor) for v in once]], key=repr)


def test_draw_job(spark, tmp_path):
    samples = spark.createDataFrame([("c1", "w1"), ("c1", "w2"), ("c2", "w2")], "corpus string, word string")
    text_jobs.run_draw_groups(spark, samples, f"{tmp_path}/out", 5, ignore_corpus="c1", ignore_word="w1")
    assert rows(read_csv(spark, f"{tmp_path}/out")) == [(f"id{i}", "c2", "w2") for i in range(5)]


def test_load_users_job(spark, tmp_path):
    header = "id,first_name,last_name,email,gender\n"
    put(tmp_path, "u1.csv", header + '1,Ann,"Lee, jr",a@x.org,F\n')
    put(tmp_path, "u2.csv", header + "2,Bob,,b@x.org,M\n")
    for _ in range(2):
        text_jobs.run_load_users(spark, f"{tmp_path}/u*.csv", path=f"{tmp_path}/users")
    expected = [(1, "Ann", "Lee, jr", "a@x.org", "F"), (2, "Bob", "", "b@x.org", "M")]
    assert rows(spark.read.parquet(f"{tmp_path}/users")) == sorted(expected * 2, key=repr)
    put(tmp_path, "u3.csv", header + "x,Cy,D,c@x.org,M\n")
    with pytest.raises(Exception, match="row does not fit"):
        text_jobs.run_load_users(spark, f"{tmp_path}/u*.csv", path=f"{tmp_path}/users")
    parsed = text_jobs.run_load_users(spark, f"{tmp_path}/u*.csv", path=f"{tmp_path}/more", strict=False)
    assert rows(spark.read.parquet(f"{tmp_path}/more")) == sorted(expected, key=repr)
    assert rows(parsed.rejects) == [("x,Cy,D,c@x.org,M",)]


def test_borough_job(spark, tmp_path):
    drop = [239, 246, 236, 193, 193, 193, 193, 229, 7]
    count = [1, 1, 3, 5, 5, 5, 5, 1, 1]
    rides = "passenger_count,DOLocationID,congestion_surcharge\n" + "".join(f"{c},{d},\n" for c, d in zip(count, drop))
    for i in range(100):
        put(tmp_path, f"rides{i}.csv", rides)
    boroughs = {7: "Queens", 193: "Queens", 229: "Manhattan", 236: "Manhattan", 239: "Manhattan", 246: "Manhattan"}
    zones = '"LocationID","Borough"\n' + "".join(f'{i},"{b}"\n' for i, b in boroughs.items())
    lookup = put(tmp_path, "lookup.csv", zones)
    frame_jobs.run_passengers_per_borough(spark, f"{tmp_path}/rides*.csv", lookup, f"{tmp_path}/out")
    found = lines_in(f"{tmp_path}/out")
    assert set(found) == {"Borough,passenger_count", "Manhattan,600", "Queens,2100"}


def flights(spark):
    head = "FlightDate date, IATA_CODE_Reporting_Airline string, Origin string, Dest string, DepDelay int, ArrDelay int"
    data = [
        ("2012-12-22", "AA", "P", "Q", 10, 20), ("2012-12-22", "AA", "Q", "P", 30, 40),
        ("2012-12-22", "AA", "P", "R", 99, 99), ("2012-12-22", "BB", "P", "Q", 1, 1),
        ("2012-12-23", "AA", "P", "P", 5, 6), ("2012-12-23", "AA", "P", "P", None, 6),
        ("2012-12-23", "AA", "P", "P", 5, None), ("2012-12-24", "AA", "P", "P", 7, 7),
    ]
    return spark.createDataFrame([(d, *r) for d, *r in data], head.replace("date,", "string,")).selectExpr(
        "CAST(FlightDate AS date) AS FlightDate", "* EXCEPT (FlightDate)"
    )


def test_flight_delays(spark, tmp_path):
    found = frame_jobs.flight_delays(flights(spark), "2012-12-22", "2012-12-23")
    assert rows(found) == [
        ("2012-12-22", "AA", 20.0, 30.0),
        ("2012-12-22", "BB", None, None),
        ("2012-12-23", "AA", 5.0, 6.0),
    ]
    with pytest.raises(ValueError):
        frame_jobs.flight_delays(flights(spark), "2012-12-22", "2013-01-01")
    frame_jobs.run_flight_delays(flights(spark), f"{tmp_path}/out", "2012-12-23", "2012-12-24")
    assert read_csv(spark, f"{tmp_path}/out").count() == 2


def test_price_job(spark, tmp_path):
    header = ",".join([*model_jobs.PRICE_MODELS["all_features"], "TradePrice"])
    a = put(tmp_path, "a.csv", header + "\n10,2000,1,2,3,4,5,6,1000\n10,2000,,,3,,,,2000\n")
    b = put(tmp_path, "b.csv", header + "\n10,2000,1,2,,,,,3000.5\n10,2000,,,,,,,\n,2000,,,,,,,5000\n")
    names = list(model_jobs.PRICE_MODELS)

    def factory(name):
        place = names.index(name)
        return lambda rows: 0.5 + place * rows["Area"]

    scored = model_jobs.run_price_report(spark, f"{a},{b}", f"{tmp_path}/out", factory)
    assert lines_in(f"{tmp_path}/out") == [
        "True Price 1000, Predicted Price 0",
        "True Price 2000, Predicted Price 10",
        "True Price 3000, Predicted Price 20",
        "True Price nan, Predicted Price 30",
    ]
    assert [r.TradePrice for r in scored.rejects.collect()] == [5000.0]
    with pytest.raises(ValueError):
        model_jobs.run_price_report(spark, a, f"{tmp_path}/no")


def test_masked_words_job(spark, lines, tmp_path):
    model = model_jobs.train_next_word(lines(["the capital of france is paris"]))
    source = put(tmp_path, "in.txt", "The capital of France is Rome .\n \nIt is so .\n")
    model_jobs.run_masked_words(spark, source, f"{tmp_path}/out", model)
    assert lines_in(f"{tmp_path}/out") == ["It is so .;paris", "The capital of France is Rome .;paris"]
    assert masking.bigram_counts(lines([])).count() == 0

    def load():
        return lambda texts: texts.str.len().astype(str)

    model_jobs.run_masked_words(spark, source, f"{tmp_path}/own", model_factory=load, max_batch=1)
    assert lines_in(f"{tmp_path}/own") == ["It is so .;14", "The capital of France is Rome .;33"]
    with pytest.raises(ValueError):
        model_jobs.run_masked_words(spark, source, f"{tmp_path}/no")


def test_append_orders_and_types_columns(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, name string").schema
    append_table(spark.createDataFrame([("a", "1")], "name string, id string"), schema, path=f"{tmp_path}/t")
    append_table(spark.createDataFrame([(2, "b")], "id bigint, name string"), schema, path=f"{tmp_path}/t")
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        append_table(spark.range(1), schema)
    for i in range(2):
        append_table(spark.createDataFrame([(i, "x")], "id int, name string"), schema, table="appended")
    assert rows(spark.table("appended")) == [(0, "x"), (1, "x")]


def test_csv_sources(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'a "q", b'), (2, None)], "id int, name string")
    write_csv(frame, f"{tmp_path}/x")
    assert rows(read_csv(spark, f"{tmp_path}/x", infer=True)) == rows(frame)
    assert rows(read_csv(spark, f"{tmp_path}/x")) == rows(frame.selectExpr("CAST(id AS string) AS id", "name"))
    both = read_csv_list(spark, f"{tmp_path}/x, {tmp_path}/x", "id int, name string")
    assert both.count() == 4


def test_pruned_and_pushed_down(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    frame = read_table(spark.read.parquet(f"{tmp_path}/t"), {"x": "a"}, not_null=["b"])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan and "IsNotNull(b)" in plan


def test_group_ids(spark):
    assert rows(group_ids(spark, 3)) == [("id0",), ("id1",), ("id2",)]


def test_scratch_names_are_new_and_shared(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert not base or scratch_dir(spark, "x").startswith(base)
    assert rows(materialize(spark.range(2), "m")) == [(0,), (1,)]


class Elsewhere:
    """As much of a session on a cluster as the scratch folder asks for."""

    def __init__(self, warehouse, checkpoint=None):
        self.settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId = "spark://host:7077", "elsewhere"

    def get(self, name, default=None):
        return self.settings[name] or default


def test_no_scratch_in_a_folder_of_the_driver():
    own = f"file:{os.getcwd()}/spark-warehouse"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Elsewhere(own), "x")
    assert scratch_dir(Elsewhere(own, "hdfs:/shared"), "x").startswith("hdfs:/shared/x-")
    assert scratch_dir(Elsewhere("file:/shared/warehouse"), "x").startswith("file:/shared/warehouse/scratch/x-")


def test_append_takes_no_unfit_value(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, name string").schema
    mixed = spark.createDataFrame([("1", "a"), ("abc", "x"), (None, "y")], "id string, name string")
    with pytest.raises(Exception, match="no int for id: abc"):
        append_table(mixed, schema, path=f"{tmp_path}/strict")
    left = append_table(mixed, schema, path=f"{tmp_path}/some", strict=False)
    assert rows(left) == [("abc", "x")]
    assert rows(spark.read.parquet(f"{tmp_path}/some")) == sorted([(1, "a"), (None, "y")], key=repr)


def test_dropped_scratch_leaves_nothing(spark, tmp_path):
    frame = materialize(spark.range(3), "gone")
    folder = frame.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert glob.glob(f"{folder}/part-*")
    assert drop_scratch(spark) > 0
    assert not glob.glob(folder)


def test_headers_go_where_files_are_split(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"{i}.csv", f"head {i}\n" + "".join(f"{i} {n}\n" for n in range(500)))
    put(tmp_path, "only.csv", "head only")
    put(tmp_path, "empty.csv", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("500", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = rows(read_lines(spark, f"{tmp_path}/*.csv", skip_header=True))
            assert found == sorted([(f"{i} {n}",) for i in range(3) for n in range(500)], key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


ODD = st.one_of(st.none(), st.text(alphabet=" \t\r\n\"\\N,ab\u00e9", max_size=8))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(ODD, ODD), min_size=1, max_size=12))
def test_exact_csv_gives_back_what_it_got(spark, tmp_path_factory, values):
    path = str(tmp_path_factory.mktemp("exact") / "out")
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a string, b string").coalesce(1)
    write_csv(frame, path, exact=True)
    assert rows(read_csv(spark, path, "i int, a string, b string", exact=True)) == rows(frame)


def test_plain_csv_keeps_blanks_and_refuses_line_ends(spark, tmp_path):
    frame = spark.createDataFrame([("  x ", "\ty"), ("", None)], "a string, b string")
    write_csv(frame, f"{tmp_path}/x")
    assert rows(read_csv(spark, f"{tmp_path}/x")) == sorted([("  x ", "\ty"), (None, None)], key=repr)
    with pytest.raises(Exception, match="line end"):
        write_csv(spark.createDataFrame([("a\nb",)], "a string"), f"{tmp_path}/y")

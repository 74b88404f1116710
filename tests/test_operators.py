"""Counting, splits, joins, top-k and parsing on small frames."""

import collections
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.operators import counting, joins, parse, split, sqlframe, topk
from tests.conftest import rows


def test_word_count(lines):
    sample = ["a b c a b a", "acento gráfico", "July 30, 2018", "", " aa bb cc aa bb aa"]
    assert dict(rows(lines(sample).transform(counting.word_count))) == {
        "a": 3, "b": 2, "c": 1, "acento": 1, "gráfico": 1, "July": 1, "30": 1, "2018": 1, "aa": 3, "bb": 2, "cc": 1,
    }


def test_format_counts(lines):
    counts = lines(["x y x"]).transform(counting.word_count)
    assert rows(counts.transform(counting.format_counts)) == [("x: 2",), ("y: 1",)]


def test_count_elements_keeps_null_and_value_counts_drops_it(lines):
    frame = lines(["a", None, "a", None])
    assert rows(frame.transform(counting.count_elements, "value", factor=3)) == [("a", 6), (None, 6)]
    assert rows(frame.transform(counting.value_counts, "value")) == [("a", 2)]


def test_keyed_sum(spark):
    frame = spark.createDataFrame([("a", 1), ("a", None), ("b", None), (None, 5)], "k string, v int")
    assert rows(counting.keyed_sum(frame, "k", "v")) == [("a", 1), ("b", 0)]
    gaps = spark.createDataFrame([("a", 1.5), ("a", float("nan")), ("b", float("nan"))], "k string, v double")
    assert rows(counting.keyed_sum(gaps, "k", "v")) == [("a", 1.5), ("b", 0.0)]


def test_total_of_nothing_has_no_row(lines):
    assert rows(counting.total(lines([]), F.length("value"))) == []
    assert rows(counting.total(lines(["", "abc"]), F.length("value"))) == [(3,)]


def test_split_words(lines):
    stats = lines(["A whole new world", "A new fantastic point of view"]).transform(split.word_stats)
    frames = split.split_words(stats)
    assert rows(frames[split.SHORT]) == [("A", 2), ("new", 2), ("of", 1)]
    assert rows(frames[split.LONG]) == [(w, 1) for w in ("fantastic", "point", "view", "whole", "world")]
    assert rows(frames[split.CHARS]) == [(46,)]


def test_split_words_counts_characters_of_lines_without_words(lines):
    frames = split.split_words(lines(["", "123", "ab ab", None]).transform(split.word_stats))
    assert rows(frames[split.CHARS]) == [(8,)]
    assert rows(frames[split.SHORT]) == [("ab", 2)]
    empty = split.split_words(lines([]).transform(split.word_stats))
    assert [rows(f) for f in empty.values()] == [[], [], []]


def test_partition_rows_takes_the_first_that_fits(spark):
    parts = split.partition_rows(spark.range(6), {"even": F.col("id") % 2 == 0, "small": F.col("id") < 4})
    assert {k: rows(v) for k, v in parts.items()} == {"even": [(0,), (2,), (4,)], "small": [(1,), (3,)]}
    assert rows(split.union_all(*parts.values(), spark.range(1))) == [(0,), (0,), (1,), (2,), (3,), (4,)]


RIDES = [(1, 239), (1, 246), (3, 236), (5, 193), (5, 193), (5, 193), (5, 193), (1, 229), (1, 7)]
ZONES = [(7, "Queens"), (193, "Queens"), (229, "Manhattan"), (236, "Manhattan"), (239, "Manhattan"), (246, "Manhattan")]


def test_lookup_sum(spark):
    rides = spark.createDataFrame([*RIDES, (9, 1000), (9, None)], "passenger_count int, DOLocationID int")
    zones = spark.createDataFrame([*ZONES, (8, None)], "LocationID int, Borough string")
    found = joins.lookup_sum(rides, zones, "DOLocationID", "LocationID", "Borough", "passenger_count")
    assert found.columns == ["Borough", "passenger_count"]
    assert rows(found) == [("Manhattan", 6), ("Queens", 21)]


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.none() | st.integers(0, 4), st.none() | st.integers(0, 9)), max_size=30),
    st.lists(st.tuples(st.integers(0, 5), st.none() | st.sampled_from("xyz")), max_size=12),
)
def test_lookup_sum_equals_join_then_sum(spark, facts, lookup):
    left = spark.createDataFrame(facts, "k int, v int")
    right = spark.createDataFrame(lookup, "id int, g string")
    joined = joins.lookup_join(left, right, "k", "id").transform(counting.keyed_sum, "g", "v")
    assert rows(joins.lookup_sum(left, right, "k", "id", "g", "v")) == rows(joined)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    facts = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"), "id")
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (7, None)], "key bigint, name string")
    plain = joins.lookup_join(facts, lookup, "k", "key", how)
    salted = joins.lookup_join(facts, lookup, "k", "key", how, salts=5)
    assert salted.columns == plain.columns == ["k", "id", "name"]
    assert rows(salted) == rows(plain)
    assert plain.where("k = 1").count() == 2 * facts.where("k = 1").count()
    with pytest.raises(ValueError):
        joins.lookup_join(facts, lookup, "k", "key", "full")


HOT_JOINS = {
    "lookup": lambda facts, lookup: joins.lookup_join(facts, lookup, "k", "key"),
    "members": lambda facts, lookup: joins.keep_members(facts, "k", lookup, "key"),
    "top": lambda facts, lookup: topk.top_k_ties(facts, ["k"], "id", 100_000),
}


@pytest.mark.parametrize("kind", HOT_JOINS)
def test_hot_key_join_is_split(spark, kind):
    """A shuffle join whose one key holds a third of the rows reads it in parts."""
    names = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    ]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in zip(names, ["-1", "10KB", "2", "10KB"]):
            spark.conf.set(name, value)
        facts = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).alias("k"), "id"
        )
        lookup = spark.range(1000).select(F.col("id").alias("key"), F.col("id").cast("string").alias("name"))
        joined = HOT_JOINS[kind](facts, lookup)
        assert len(joined.collect()) == 90000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_members_and_aligned_counts(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), (None,), ("a",)], "k string")
    assert rows(joins.keep_members(left, "k", right, "k")) == [("a",), ("a",)]
    assert rows(joins.aligned_count_sum(left, right, "k")) == [("a", 4)]


def test_single_value(spark):
    frame = spark.range(3)
    one = spark.createDataFrame([(10,)], "v int")
    assert rows(frame.select(F.col("id") + joins.single_value(one, "v"))) == [(10,), (11,), (12,)]
    for wrong in (one.limit(0), one.unionByName(one)):
        with pytest.raises(Exception, match="expected one row"):
            frame.select(joins.single_value(wrong, "v")).collect()


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(0, 6)), max_size=40),
    st.integers(1, 5),
)
def test_top_k_ties_is_nlargest(spark, values, k):
    frame = spark.createDataFrame(values, "g string, v int")
    expected = []
    for group in {g for g, _ in values}:
        series = pd.Series([v for g, v in values if g == group and v is not None], dtype="float64")
        expected += [(group, int(v)) for v in series.nlargest(k, keep="all")]
    assert rows(topk.top_k_ties(frame, ["g"], "v", k)) == sorted(expected, key=repr)


def hub_means(trips, k):
    """The same by brute force, on plain rows."""
    found = {}
    for group in {t[0] for t in trips if t[0] is not None}:
        mine = [t for t in trips if t[0] == group]
        out = collections.Counter(t[1] for t in mine if t[1] is not None)
        into = collections.Counter(t[2] for t in mine if t[2] is not None)
        busy = {h: out[h] + into[h] for h in out if h in into}
        least = sorted(busy.values(), reverse=True)[:k][-1] if busy else None
        delays = [t[3] for t in mine if t[2] in busy and busy[t[2]] >= least and t[3] is not None and t[3] == t[3]]
        found[group] = sum(delays) / len(delays) if delays else None
    return sorted(found.items(), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_top_hub_mean(spark, seed):
    pick = random.Random(seed)
    hubs = ["h%d" % i for i in range(12)] + [None]
    trips = [
        (pick.choice(["x", "y", "z", None]), pick.choice(hubs), pick.choice(hubs), pick.choice([None, 1.0, 2.0, 7.0]))
        for _ in range(150)
    ]
    trips += [("only-in", "p", "q", 1.0), ("no-delay", "p", "p", None)]
    trips += [("half", "p", "p", 1.0), ("half", "p", "p", float("nan"))]
    frame = spark.createDataFrame(trips, "g string, dep string, arr string, delay double")
    assert rows(topk.top_hub_mean(frame, ["g"], "dep", "arr", ["delay"], 3)) == hub_means(trips, 3)


USERS = ["1,Ann,Lee,a@x.org,F", '2,"O""Neil, jr",B,,M,extra', "3,Short", "x,Bad,Id,b@x.org,M", ""]


def test_csv_lines_with_rejects(lines):
    kinds = {"id": "int", "first": "string", "last": "string", "email": "string", "gender": "string"}
    parsed = parse.parse_csv_lines(lines(USERS), kinds)
    assert rows(parsed.rows) == [
        (1, "Ann", "Lee", "a@x.org", "F"),
        (2, 'O"Neil, jr', "B", "", "M"),
        (3, "Short", None, None, None),
        (None, None, None, None, None),
    ]
    assert rows(parsed.rejects) == [("x,Bad,Id,b@x.org,M",)]
    with pytest.raises(Exception, match="row does not fit: x,Bad"):
        parse.parse_csv_lines(lines(USERS), kinds, strict=True).rows.collect()
    assert parse.parse_csv_lines(lines(USERS[:3]), kinds, strict=True).rows.count() == 3


def test_json_rows_with_rejects(lines):
    values = ['{"s": "up", "n": 2}', '{"s": null, "n": 1}', '{"n": 1}', '{"s": "x", "n": "two"}', "nope", None]
    parsed = parse.parse_json_rows(lines(values), {"s": "text", "n": "int"})
    assert rows(parsed.rows) == [("None", 1), ("up", 2)]
    assert parsed.rejects.count() == 4
    with pytest.raises(Exception, match="row does not fit"):
        parse.parse_json_rows(lines(values), {"s": "text", "n": "int"}, strict=True).rows.collect()


def test_sql_transform_drops_null_status(spark):
    frame = spark.createDataFrame([("up", 2), ("up", 3), ("enroute", 1), (None, 9)], "status string, n int")
    found = sqlframe.sql_transform(
        frame,
        "SELECT status, count(*) AS c, sum(n) AS t FROM {rows} WHERE NOT status = :skip GROUP BY status",
        skip="enroute",
    )
    assert rows(found) == [("up", 2, 5)]
    assert rows(sqlframe.sql_transform(frame, "SELECT count(*) FROM {rides}", name="rides")) == [(4,)]


def test_present_columns(spark):
    frame = spark.createDataFrame([(1.0, "a"), (float("nan"), "a"), (2.0, None)], "x double, s string")
    assert rows(frame.where(split.all_present(["x", "s"]))) == [(1.0, "a")]


def test_words_pattern_is_a_parameter(lines):
    assert rows(lines(["ab1 é"]).transform(counting.explode_words, pattern=text.ASCII_WORD)) == [("ab",)]

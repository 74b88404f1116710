"""Column functions against Python's own."""

import csv
import json
import re
import sys
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.functions.csvline import csv_fields
from flowkit.functions.jsonrow import json_int, json_text, to_json_text
from flowkit.functions.times import bound_text, check_day, epoch_seconds, parse_day

from tests.conftest import rows

few = settings(max_examples=12, deadline=None)
# Below U+0870 Java and Python agree on what a letter is.
old_chars = st.characters(max_codepoint=0x86F, exclude_categories=["Cs"])
texts = st.lists(st.text(st.one_of(old_chars, st.sampled_from(" '_\t \x1c ab²"))), min_size=1, max_size=40)


def apply(spark, values, kind, expression):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, value {kind}")
    return [r.out for r in frame.select("i", expression(F.col("value")).alias("out")).orderBy("i").collect()]


@few
@given(texts)
def test_words_are_those_of_re(spark, values):
    assert apply(spark, values, "string", text.words) == [re.findall(r"[\w']+", v, re.UNICODE) for v in values]


def test_word_characters_are_those_of_re(spark):
    """Every code point there is, in the Unicode version of this Python."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    lines = [" ".join(points[i : i + 2000]) for i in range(0, len(points), 2000)]
    found = apply(spark, lines, "string", text.words)
    assert found == [re.findall(r"[\w']+", v) for v in lines]
    assert sum(map(len, found)) > 138_000


@few
@given(texts)
def test_ascii_words_are_those_of_re(spark, values):
    found = apply(spark, values, "string", lambda c: text.words(c, text.ASCII_WORD))
    assert found == [re.findall(r"[A-Za-z']+", v) for v in values]


@few
@given(texts)
def test_strip_and_tokens_are_those_of_str(spark, values):
    assert apply(spark, values, "string", text.strip) == [v.strip() for v in values]
    assert apply(spark, values, "string", text.tokens) == [v.split() for v in values]
    assert apply(spark, values, "string", text.has_text) == [bool(v.strip()) for v in values]


def test_masked_token(spark):
    values = ["The sun is up .", "one", "one two", "  a\tb   c  ", "We left the old house early ."]
    assert apply(spark, values, "string", text.mask_token) == [
        "The sun is [MASK] .",
        "[MASK] one",
        "[MASK] two",
        "a [MASK] c",
        "We left the old house [MASK] .",
    ]
    assert apply(spark, ["a b c d"], "string", lambda c: text.mask_token(c, 2)) == ["a [MASK] c d"]


@few
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=0, max_value=1e15), min_size=1))
def test_whole_number_is_percent_f(spark, values):
    values = [*values, 0.5, 1.5, 2.5, 1e6 + 0.5, 900.5]
    assert apply(spark, values, "double", text.whole_number) == ["%.0f" % v for v in values]


def test_whole_number_without_a_number(spark):
    values = [None, float("nan"), float("inf"), float("-inf"), -3.5, -2.5]
    assert apply(spark, values, "double", text.whole_number) == ["nan", "nan", "inf", "-inf", "-4", "-2"]


def test_length_counts_code_points(spark):
    values = ["abc", "gráf", "\U0001f600" * 3]
    assert apply(spark, values, "string", text.is_short) == [True, False, True]


csv_texts = st.lists(st.text(st.sampled_from('ab,," \'\té'), max_size=14), min_size=1, max_size=60)


@settings(max_examples=40, deadline=None)
@given(csv_texts)
def test_csv_fields_are_those_of_the_csv_module(spark, values):
    assert apply(spark, values, "string", csv_fields) == [list(csv.reader([v]))[0] for v in values]


def test_csv_long_field(spark):
    line = '"' + 'a""' * 20000 + '",' + "b" * 100000
    assert apply(spark, [line], "string", csv_fields) == list(csv.reader([line]))


def python_int(value):
    try:
        return int(json.loads(value)["n"])
    except (KeyError, ValueError, TypeError):
        return None


def python_text(value):
    try:
        return str(json.loads(value)["n"])
    except (KeyError, ValueError):
        return None


def test_json_int(spark):
    values = [
        '{"n": 3}', '{"n": 2.7}', '{"n": -2.7}', '{"n": "12"}', '{"n": " 12 "}', '{"n": "2.7"}', '{"n": "x"}',
        '{"n": null}', '{"m": 1}', '{"n": true}', '{"n": [1]}', '{"n": {"a": 1}}', "no json", '{"n": 9007199254740993}',
        '{"n": 1e3}', '{"n": ""}',
        '{"n": 1, "n": 2}',
    ]
    found = apply(spark, values, "string", lambda c: json_int(F.try_parse_json(c), "n"))
    assert found == [python_int(v) for v in values]


def test_json_text(spark):
    values = ['{"n": "a"}', '{"n": null}', '{"n": 3}', '{"n": true}', '{"n": false}', '{"m": 1}', "no json"]
    found = apply(spark, values, "string", lambda c: json_text(F.try_parse_json(c), "n"))
    assert found == [python_text(v) for v in values]


def test_json_row_names_its_nulls(spark):
    frame = spark.createDataFrame([("a", None), (None, 2)], "s string, n int")
    assert [json.loads(r[0]) for r in frame.select(to_json_text("s", "n")).collect()] == [
        {"s": "a", "n": None},
        {"s": None, "n": 2},
    ]


def test_days_and_bounds(spark):
    frame = spark.createDataFrame([("2012-12-24",), ("24.12.2012",)], "t string")
    day = parse_day(F.col("t"))
    assert rows(frame.select(day, epoch_seconds(day))) == [(None, None), (date(2012, 12, 24), 1356307200)]
    moment = spark.sql("SELECT timestamp '2024-01-01 00:00:15' AS t")
    assert moment.select(bound_text(F.col("t"))).first()[0] == "2024-01-01 00:00:15.000000 UTC"


def test_day_argument():
    bounds = date(2002, 1, 1), date(2012, 12, 31)
    assert check_day("2012-12-31", *bounds) == "2012-12-31"
    for wrong in ("2013-01-01", "2001-12-31", "soon"):
        with pytest.raises(ValueError):
            check_day(wrong, *bounds)

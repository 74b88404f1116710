"""Draws from lists."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from flowkit.operators import side
from flowkit.plans.text_jobs import draw_groups
from flowkit.sources.files import group_ids
from tests.conftest import rows


def frame_of(spark, values, name="f"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_forced_draw(spark):
    groups = frame_of(spark, ["A", "B", "C"], "id")
    found = draw_groups(
        groups, "id", frame_of(spark, ["corpus1", "corpus2"]), frame_of(spark, ["word1", "word2"]), "corpus1", "word1"
    )
    assert rows(found) == [(g, "corpus2", "word2") for g in "ABC"]


def test_draw_is_even_repeatable_and_leaves_out(spark):
    values = [f"w{i}" for i in range(6)] + ["", None]

    def draw(seed):
        return side.draw(group_ids(spark, 6000), "group_id", frame_of(spark, values), "f", "w0", seed)

    found = rows(draw(1))
    counts = collections.Counter(v for _, v in found)
    assert set(counts) == {f"w{i}" for i in range(1, 6)}
    assert all(1000 < n < 1400 for n in counts.values())
    assert found == rows(draw(1)) != rows(draw(2))


def test_one_that_occurs_twice_is_drawn_twice_as_often(spark):
    found = side.draw(group_ids(spark, 6000), "group_id", frame_of(spark, ["a", "b", "b"]), "f")
    assert 3800 < found.where("f = 'b'").count() < 4200


def test_long_list(spark):
    values = spark.range(20000).selectExpr("concat('v', id) AS f")
    found = side.draw(group_ids(spark, 3000), "group_id", values, "f")
    assert found.where("f IS NULL").count() == 0
    assert found.select("f").distinct().count() > 2500


def test_no_candidate(spark):
    with pytest.raises(Exception, match="no candidate"):
        side.draw(group_ids(spark, 2), "group_id", frame_of(spark, ["a", ""]), "f", "a").collect()
    assert side.draw(group_ids(spark, 0), "group_id", frame_of(spark, ["a"]), "f", "a").collect() == []


def test_places_have_no_gap(spark):
    values = spark.range(300).selectExpr("concat('v', id) AS value", "IF(id = 5, 100, 1 + id % 2) AS copies")
    found = sorted(rows(side.value_starts(values)), key=lambda r: r[2])
    assert len(found) == 300
    at = 0
    for value, copies, start in found:
        assert start == at and copies == (100 if value == "v5" else 1 + int(value[1:]) % 2)
        at += copies
    order = [hashlib.md5(v.encode()).hexdigest() for v, _, _ in found]
    assert order == sorted(order)


def placed(values, group, seed):
    """The value whose places hold the one that a group draws, one by one."""
    listed = sorted(values, key=lambda v: hashlib.md5(v[0].encode()).hexdigest())
    size = sum(n for _, n in listed)
    at = int(hashlib.md5(f"{group}:{seed}".encode()).hexdigest()[:15], 16) % size
    for value, copies in listed:
        if at < copies:
            return value
        at -= copies


LISTS = {
    "one": [("a", 1)],
    "few": [("a", 3), ("b", 1), ("c", 2)],
    "even": [(f"v{i}", 1 + i % 3) for i in range(3000)],
    "heavy": [("big", 10**9), *[(f"v{i}", 1) for i in range(500)]],
    "two heavy": [("big", 10**12), ("large", 10**12), *[(f"v{i}", 10**6) for i in range(6000)]],
    "beyond 32 bits": [(f"v{i}", 3 * 10**13 + i) for i in range(50)],
}


@pytest.mark.parametrize("name", LISTS)
def test_weighted_draws_are_those_of_the_definition(spark, name):
    values = spark.createDataFrame(LISTS[name], "value string, copies bigint")
    assert side.value_starts(values).count() == len(LISTS[name])
    groups = group_ids(spark, 800).withColumn("x", F.lit(1)).withColumn("value", F.lit("old"))
    found = side.draw_weighted(groups, "group_id", values, 3)
    assert found.columns == ["group_id", "x", "value"]
    assert {r.group_id: r.value for r in found.collect()} == {f"id{i}": placed(LISTS[name], f"id{i}", 3) for i in range(800)}


def test_no_value_is_copied_and_draws_are_spread(spark):
    """Ten groups or a million: a list of three values is three rows, and the draws lie in many cells."""
    values = spark.createDataFrame(LISTS["few"], "value string, copies bigint")
    drawn = side.draw_weighted(group_ids(spark, 20_000), "group_id", values, 1)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert drawn.count() == 20_000
    per = -(-side.BUCKETS // 6)
    cells = side._cells(values, per, -(-6 * per // side.BUCKETS))
    assert cells.count() == side.BUCKETS and sum(len(r.heads) for r in cells.collect()) == 3

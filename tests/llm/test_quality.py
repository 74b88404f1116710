"""Quality measures against a plain version, and verdicts on hosts."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowkit.llm.quality import host_rates, judge_documents, keep_good_documents, quality_measures, rejected_hosts
from tests.llm.helpers import clashing, corpus, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \x0b\n",
    "one",
    "a a a a a",
    "a a a a a a a a",
    "one two three four five six one two three four five",
    "x\ny\nx\n\n\nx \nx",
    "é ñ 𝔘𝔫𝔦 #*$%&|<>  z",
    "line of words\r\nline of words\r\nline of words\r",
    "w " * 20000,
    *[t for _, t in corpus(11, 30, 80, 6)],
]


def test_measures(spark):
    docs = frame(spark, list(enumerate(TEXTS)))
    got = docs.select("doc_id", quality_measures(F.col("text")).alias("m")).select("doc_id", "m.*").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_judged_rows(spark):
    rows = [*enumerate(TEXTS), (3, "one"), (None, "some words of a text " * 5)]
    got = judge_documents(clashing(frame(spark, rows))).collect()
    want = []
    for i, t in rows:
        m = plain(t)
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        want.append((i, *m, failed, not failed))
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert judge_documents(frame(spark, [])).count() == 0


GOOD = "these are more than ten quite different words that nobody could find fault with"


def hosts(spark):
    rows = [(f"bad{n}", i >= 2) for n in range(3) for i in range(400)]  # all but two fail
    rows += [(f"good{n}", i < n) for n in range(30) for i in range(40)]
    rows += [("small", True), (None, True), (None, False)]
    return spark.createDataFrame(rows, "host string, failed boolean")


def test_hosts_are_drawn_to_the_prior(spark):
    rates = {r.host: r for r in host_rates(hosts(spark)).collect()}
    assert None not in rates
    assert rates["bad0"].rate > 0.95
    assert 0.3 < rates["small"].rate < 1 and rates["small"].low < 0.9
    assert {r.host for r in rejected_hosts(hosts(spark)).collect()} == {"bad0", "bad1", "bad2"}


@pytest.mark.parametrize("rows", [[], [("a", True)], [("a", False)], [(None, True)], [("a", True), ("b", True)]])
def test_few_hosts(spark, rows):
    frame = spark.createDataFrame(rows, "host string, failed boolean")
    assert host_rates(frame).count() == len({h for h, _ in rows if h})


def test_a_rejected_host_takes_its_good_documents_along(spark):
    rows = [(i, "short", "junk") for i in range(800)] + [(900, GOOD, "junk")]
    rows += [(1000 + i, f"{GOOD} {i}", "fine") for i in range(300)] + [(2000, GOOD, None), (None, GOOD, "fine"), (1000, f"{GOOD} 0", "fine")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    verdicts = {r.doc_id: r for r in judge_documents(docs).collect()}
    assert not verdicts[900].base_failed and not verdicts[900].kept
    assert verdicts[2000].kept and verdicts[None].kept
    kept = keep_good_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, s in rows if s != "junk")
    assert keep_good_documents(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    docs = frame(spark, [(1, GOOD)])
    for out in (judge_documents(docs), keep_good_documents(docs), docs.select(quality_measures(F.col("text")))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)

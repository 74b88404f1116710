"""Hosts, paths, rules and reputation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowkit.llm.catalog import _RULES
from flowkit.llm.urls import beta_below, host_reputation, judge_urls, url_host, url_path
from tests.llm.helpers import clashing


@pytest.mark.parametrize(
    "url,host,path",
    [
        (None, "", ""),
        ("", "", ""),
        ("no scheme", "", ""),
        ("http://", "", ""),
        ("http://A.Example.ORG", "a.example.org", ""),
        ("http://É.org/Ä?x", "É.org", "/Ä"),
        ("http://h.org?x=/y", "h.org", ""),
        ("http://h.org#/y", "h.org", ""),
        ("a://b://c/d://e?f", "b:", "//c/d://e"),
        ("x\ny://h.com/a\nb?c", "h.com", "/a\nb"),
    ],
)
def test_parts(spark, url, host, path):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(url_host(F.col("url")), url_path(F.col("url"))).first()[:] == (host, path)


def pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def outcomes(spark, rows=()):
    return spark.createDataFrame(list(rows), "page_id long, bad int")


def test_rules(spark):
    urls = {
        "http://x.org/a": ("org/", "allow"),
        "http://x.org": (None, "allow"),
        "http://example.org/es/1": ("example.org/es/", "block"),
        "http://m.example.org/en/12": ("example.org/en/1", "block"),
        "http://notexample.org/es/1": ("org/", "allow"),
        "http://a.com/fr/": ("com/fr/", "allow"),
        "http://a.com/de/x": ("com/de/", "block"),
        "http://com/de/": ("com/de/", "block"),
        "http://telecom/de/": (None, "allow"),
        "http://a.net/de/": (None, "allow"),
    }
    got = judge_urls(clashing(pages(spark, list(urls))), outcomes(spark), _RULES).collect()
    assert {list(urls)[r.page_id]: (r.rule, r.verdict) for r in got} == urls


def test_reputation_blocks_hosts_that_are_bad_beyond_doubt(spark):
    urls = [f"http://bad.spam.net/{i}" for i in range(200)] + [f"http://good{i % 9}.net/{i}" for i in range(400)]
    urls += ["http://new.spam.net/", "http://fresh.net/", None, None]
    labels = [(i, int(i % 20 != 0)) for i in range(200)] + [(i, int(i % 50 == 0)) for i in range(200, 600)]
    labels += [(None, 1), (5, None), (5, 1), (9999, 1)]
    got = judge_urls(clashing(pages(spark, urls)), outcomes(spark, labels), []).collect()
    verdicts = {r.page_id: r.verdict for r in got}
    assert len(got) == len(urls)
    assert all(verdicts[i] == "block" for i in range(200))
    assert all(verdicts[i] == "allow" for i in range(200, 600))
    # A host without labels is judged like its domain, and a new domain like its suffix.
    assert verdicts[600] == "block" and verdicts[601] == verdicts[602] == "allow"
    known = dict(labels)
    rows = [(u.split("/")[2], known.get(i)) for i, u in enumerate(urls) if u]
    hosts = {r.host: r for r in host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert hosts["new.spam.net"].doubt > hosts["bad.spam.net"].doubt
    assert 0.1 < hosts["fresh.net"].rate < 0.6 and hosts["fresh.net"].doubt > 0.2


def chance_below(x, a, b, steps=200_000):
    """By adding up the density, with a substitution that has no pole."""
    u = (np.arange(steps) + 0.5) / steps
    log_beta = math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    return np.exp((b - 1) * np.log1p(-x * u ** (1 / a)) + a * math.log(x) - math.log(a) - log_beta).mean()


@pytest.mark.parametrize("x", [0.5, 0.1, 0.9])
def test_the_posterior_is_a_beta_variable(spark, x):
    shapes = [(0.3, 0.7), (1.0, 1.0), (2.5, 4.0), (0.5, 9.0), (6.0, 1.5), (8.0, 0.2)]
    frame = spark.createDataFrame(shapes, "a double, b double")
    got = [r.below for r in frame.select(beta_below(x, F.col("a"), F.col("b")).alias("below")).collect()]
    for (a, b), below in zip(shapes, got):
        assert abs(below - chance_below(x, a, b)) < 2e-3, (a, b)
    # Against closed forms: a whole number of successes among trials.
    whole = spark.createDataFrame([(float(k), float(n - k + 1)) for n in (5, 40, 3000) for k in (1, n // 2, n)], "a double, b double")
    for r in whole.select("a", "b", beta_below(x, F.col("a"), F.col("b")).alias("below")).collect():
        n, k = int(r.a + r.b - 1), int(r.a)
        terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(x) + (n - j) * math.log(1 - x) for j in range(k)]
        want = 1 - sum(math.exp(t) for t in terms)
        assert abs(r.below - want) < 1e-8, (r.a, r.b)


def test_suffixes_of_several_labels(spark):
    """One bad domain below a shared suffix does not make its neighbours bad."""
    rows = [(f"h{i}.spam.co.uk", 1) for i in range(40) for _ in range(5)] + [(f"h{i}.good.co.uk", 0) for i in range(3)]
    rows += [("new.good.co.uk", None), ("co.uk", None), ("", None), ("uk", 0), ("x.org", 0)]
    frame = spark.createDataFrame(rows, "host string, bad int")
    listed = spark.createDataFrame([("co.uk",), ("CO.UK",), ("org",)], "suffix string")
    plain = {r.host: r.rate for r in host_reputation(frame).collect()}
    named = {r.host: r.rate for r in host_reputation(frame, suffixes=listed).collect()}
    assert plain.keys() == named.keys() == {h for h, _ in rows}
    assert plain["new.good.co.uk"] > 0.8 > named["new.good.co.uk"]


def fitting(rules, host, path):
    found = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found, default=(0, 0, None, None))[2:]


def test_a_table_of_rules_is_a_list_of_rules(spark):
    r = random.Random(8)
    labels = ["a", "b", "com", "org", "x-y"]
    rules = {(r.choice(["allow", "block"]), ".".join(r.choices(labels, k=r.randint(1, 3))), r.choice(["", "/", "/a", "/ab/", "/é"])) for _ in range(60)}
    urls = [f"http://{'.'.join(r.choices(labels, k=r.randint(1, 4)))}{r.choice(['', '/', '/a', '/ab/c', '/abc', '/é/x'])}" for _ in range(300)]
    table = spark.createDataFrame([*rules, ("allow", None, "/"), (None, "com", "/"), ("block", "only.org", None)], "verdict string, host string, path string")
    got = judge_urls(pages(spark, [*urls, None, "", "http://only.org"]), outcomes(spark), table).collect()
    assert len(got) == 303
    known = [*rules, ("block", "only.org", "")]
    for x in got:
        verdict, rule = fitting(known, x.host, x.path)
        assert (x.rule, x.verdict) == (rule, verdict or "allow")


def test_many_rules(spark):
    """A hundred thousand rules are planned and joined; one host has a third of all pages."""
    rules = spark.range(100_000).selectExpr("IF(id % 2 = 0, 'allow', 'block') AS verdict", "concat('h', id % 5000, '.org') AS host", "concat('/p', id, '/') AS path")
    rows = spark.range(6000).selectExpr("id AS page_id", "concat('http://www.h', IF(id % 3 = 0, 7, id % 5000), '.org/p', id, '/x') AS url")
    got = judge_urls(rows, outcomes(spark), rules)
    hit = got.where("rule IS NOT NULL")
    assert hit.count() == got.where("host = concat('www.h', page_id % 5000, '.org')").count()
    assert hit.where("verdict <> IF(page_id % 2 = 0, 'allow', 'block')").count() == 0


def test_repeated_rows_and_no_rows(spark):
    twice = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://b.net/")], "page_id long, url string")
    assert judge_urls(twice, outcomes(spark, [(1, 1), (1, 1)]), _RULES).count() == 3
    assert judge_urls(pages(spark, []), outcomes(spark), _RULES).count() == 0

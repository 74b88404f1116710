"""Judging URLs by rules and by the reputation of their hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.operators.hot import spread_join
from flowkit.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict, host and path of a rule.
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; NULL if none does.

    A rule fits its host and the subdomains of it, if the path starts with the
    rule's. Of rules of one length the one listed first wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, prefix in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(prefix)
        value = F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def _suffixes(host: Column) -> Column:
    """The host and every domain that it is a subdomain of, the longest first."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.size(labels))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def listed_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict``: the longest rule that fits each distinct ``host`` and ``path``.

    ``rules`` is a table of ``verdict``, ``host``, ``path``, of any length. An
    address is looked up under every domain above its host, with prefixes of
    its path of the lengths that the rules of that domain have, so each step is
    a join at equal keys. Rules that say the same of one place are one; of
    rules of one length the one with the longer host wins, and a block over an
    allow. Addresses that no rule fits do not come back.
    """
    known = materialize(
        rules.where("verdict IS NOT NULL AND host IS NOT NULL")
        .select("verdict", F.col("host").alias("own"), F.coalesce("path", F.lit("")).alias("prefix"))
        .distinct(),
        "rules",
    )
    lengths = known.groupBy(F.col("own").alias("of")).agg(F.collect_set(F.length("prefix")).alias("lengths"))
    above = urls.select("host", "path").distinct().withColumn("domain", F.explode(_suffixes(F.col("host"))))
    asked = spread_join(above, lengths, ["domain"], ["of"], "inner")
    asked = asked.withColumn("size", F.explode("lengths")).where(F.col("size") <= F.length("path"))
    asked = asked.select("host", "path", "domain", F.substring("path", F.lit(1), F.col("size")).alias("start"))
    fits = spread_join(asked, known, ["domain", "start"], ["own", "prefix"], "inner")
    order = F.struct(F.length(F.concat("domain", "start")), F.length("domain"), F.col("verdict"))
    best = F.max_by(F.struct(F.concat("domain", "start").alias("rule"), "verdict"), order)
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.*")


# Lanczos' coefficients of the gamma function (g = 7).
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)
#: Terms of the continued fraction; enough for some hundred thousand labels of a host.
_TERMS = 600


def _log_gamma(z: Column) -> Column:
    """The logarithm of the gamma function for positive numbers."""
    series = F.lit(_LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:], 1):
        series = series + F.lit(c) / (z + k)
    t = z + 7.5
    return F.lit(0.9189385332046727) + (z + 0.5) * F.log(t) - t + F.log(series) - F.log(z)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function, by its continued fraction from the innermost term out."""

    def outer(inner: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return 1 + F.when(k % 2 == 0, even).otherwise(odd) / inner

    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(x) + b * F.log(1 - x)) / a
    return front / F.aggregate(F.sequence(F.lit(_TERMS), F.lit(1)), F.lit(1.0), outer)


def beta_below(x: float, a: Column, b: Column) -> Column:
    """The chance that a beta variable with parameters ``a`` and ``b`` is at most ``x``, between 0 and 1."""
    low, high = _beta_fraction(F.lit(x), a, b), _beta_fraction(F.lit(1 - x), b, a)
    return F.when(F.lit(x) < (a + 1) / (a + b + 2), low).otherwise(1 - high)


def _concentration(children: DataFrame, parents: DataFrame, key: str) -> float:
    """How strongly children follow their parent's rate: of a beta-binomial, by the method of moments.

    Counts of rows ``n`` and ``bad`` per child; the sums that come back are one row.
    """
    p = F.col("p_bad") / F.col("p_n")
    rows = children.where("n > 0").join(
        parents.select(key, F.col("n").alias("p_n"), F.col("bad").alias("p_bad")), key
    )
    spread, chance, room = rows.agg(
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - p) ** 2),
        F.sum(p * (1 - p)),
        F.sum((F.col("n") - 1) * p * (1 - p)),
    ).first()
    correlation = (spread - chance) / room if room else 0.0
    return 1 / min(0.999, max(1e-3, correlation)) - 1


def host_reputation(outcomes: DataFrame, max_bad: float = 0.5, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior share of bad pages per host of rows ``host``, ``bad`` (NULL if not labelled).

    The rate of a host is drawn towards that of its registered domain, that
    towards its suffix, that towards all. The suffix is the longest of
    ``suffixes`` (a table with the column ``suffix``, such as ``co.uk``) that
    the host ends with, else its last label; the domain is one label longer.
    How strongly rates are drawn is estimated from the counts at each level,
    and never more than the labels behind the parent's rate warrant. Returns
    ``host``, ``n``, ``bad``, ``rate`` (the mean of the beta posterior) and
    ``doubt``, the chance that the true rate is at most ``max_bad``. A host
    without labels gets its domain's rate, and much doubt.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
    )
    labels = F.split("host", r"\.")
    if suffixes is None:
        hosts = hosts.withColumn("long", F.lit(1))
    else:
        known = suffixes.select(F.translate("suffix", _UPPER, _LOWER).alias("listed")).distinct()
        hosts = materialize(hosts, "counted-hosts")
        found = hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("above"))
        found = found.join(known, F.col("above") == F.col("listed")).groupBy(F.col("host").alias("of"))
        found = found.agg(F.max(F.size(F.split("above", r"\."))).alias("long"))
        hosts = hosts.join(found, F.col("host") == F.col("of"), "left").drop("of")
        hosts = hosts.withColumn("long", F.coalesce("long", F.lit(1)))

    def last(count: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - count + 1, F.lit(1)), count), ".")

    hosts = materialize(
        hosts.withColumn("domain", last(F.col("long") + 1))
        .withColumn("suffix", last(F.col("long")))
        .withColumn("all", F.lit(0))
        .drop("long"),
        "hosts",
    )
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix", "all").agg(*sums)
    everything = hosts.groupBy("all").agg(*sums)
    strong = {
        "all": _concentration(suffixes, everything, "all"),
        "suffix": _concentration(domains, suffixes, "suffix"),
        "domain": _concentration(hosts, domains, "domain"),
    }

    def drawn(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
        near = parents.select(key, F.col("rate").alias("prior"), F.least("size", F.lit(strong[key])).alias("weight"))
        return (
            children.join(near, key)
            .withColumn("rate", (F.col("bad") + F.col("weight") * F.col("prior")) / (F.col("n") + F.col("weight")))
            .withColumn("size", F.col("n") + F.col("weight"))
            .drop("prior", "weight")
        )

    top = everything.withColumn("rate", (F.col("bad") + 0.5) / (F.col("n") + 1.0)).withColumn("size", F.col("n") + 1.0)
    rated = drawn(hosts, drawn(domains, drawn(suffixes, top, "all"), "suffix"), "domain")
    good, bad = (1 - F.col("rate")) * F.col("size"), F.col("rate") * F.col("size")
    return rated.select("host", "n", "bad", "rate", beta_below(max_bad, bad, good).alias("doubt"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    max_bad: float = 0.5,
    doubt: float = 0.05,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """Verdict on each url of ``page_id``, ``url``.

    ``outcomes`` labels pages: ``page_id``, ``bad``; rows without either are
    passed over, several rows of a page all count. ``rules`` are a short list
    that goes into the plan, or a table (see ``listed_rules``). Where no rule
    fits, a page is blocked if the posterior leaves at most the chance
    ``doubt`` that its host's share of bad pages is ``max_bad`` or less; see
    ``host_reputation``. Returns ``page_id``, ``host``, ``path``, ``rule``,
    ``verdict``, one row per row of ``pages``; a NULL url has an empty host and
    path.
    """
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labelled = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").select("page_id", "bad")
    known = parts.select("page_id", "host").distinct().join(labelled, "page_id", "left").select("host", "bad")
    blocked = materialize(
        host_reputation(known, max_bad, suffixes)
        .where(F.col("doubt") <= doubt)
        .select("host", F.lit(True).alias("blocked")),
        "blocked-hosts",
    )
    if isinstance(rules, DataFrame):
        named = materialize(listed_rules(parts, rules), "fitting-rules")
        ruled = spread_join(parts, named, ["host", "path"], ["host", "path"])
    else:
        ruled = parts.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
        ruled = ruled.select("page_id", "host", "path", "found.rule", "found.verdict")
    own = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(blocked, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict")
    )

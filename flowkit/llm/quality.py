"""Quality rules for documents and verdicts on the hosts they come from. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.session import materialize

_WHITE = " \t\n\x0b\x0c\r"
#: Strength of the prior when hosts differ no more than chance would have it.
_STRONGEST = 1e6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(_WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def _windows(words: Column, size: int) -> Column:
    """A hash of the ``size`` words from each place."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def _covered(hashes: Column, size: int) -> Column:
    """How many words stand in a window that is found twice or more."""

    def places(pairs: Column) -> Column:
        def repeated(pair: Column, i: Column) -> Column:
            own = pair["hash"]
            left, right = F.get(pairs, i - 1)["hash"], F.get(pairs, i + 1)["hash"]
            return F.when((own == left) | (own == right), pair["at"])

        return F.array_sort(F.array_compact(F.transform(pairs, repeated)))

    def total(at: Column) -> Column:
        # A window adds its words up to where the next one begins.
        gaps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(size)), F.lit(size)))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    return _let(pairs, lambda p: _let(places(p), total))


def _repeat_words(words: Column, size: int = 5) -> Column:
    def count(hashes: Column) -> Column:
        # Most documents repeat no window; only the others are sorted.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_covered(hashes, size))

    return F.when(F.size(words) < size, 0).otherwise(_let(_windows(words, size), count))


def quality_measures(text: Column) -> Column:
    """A struct of the measures of one text; a NULL text counts as empty.

    Words are runs of other characters than ASCII white space, ``n_words`` of
    ``word_chars`` code points. ``n_symbols`` counts ``#*$%&|<>``,
    ``n_dup_lines`` the lines with a word that equal an earlier line,
    ``n_repeat_words`` the words in windows of five words that the text holds
    twice or more (told apart by a 64-bit hash within the text).
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(_WHITE)) != "")

    def measures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    return _let(_words(text), measures)


def base_failed(measures: Column, min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    """Too few words, or too many in repeated windows."""
    n = measures["n_words"]
    return (n < min_words) | (100 * measures["n_repeat_words"] > max_repeat_percent * n)


def host_rates(judged: DataFrame, z: float = 2.0) -> DataFrame:
    """Shrunk failure rate of each host of rows ``host``, ``failed``.

    The counts of all hosts give a beta prior by the method of moments: its
    mean is the overall rate, its strength follows from how far hosts differ
    beyond chance. Returns ``host``, ``n``, ``n_failed``, ``rate`` (posterior
    mean) and ``low`` (``z`` posterior deviations below it). Rows without a
    host are left out.
    """
    hosts = materialize(
        judged.where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("n_failed")),
        "hosts",
    )
    k, total, failed, squares = hosts.agg(
        F.count("*"), F.sum("n"), F.sum("n_failed"), F.sum(F.col("n").cast("double") ** 2)
    ).first()
    mean = (failed / total) if total else 0.5
    spread = hosts.agg(F.sum(F.col("n") * (F.col("n_failed") / F.col("n") - F.lit(mean)) ** 2)).first()[0] or 0.0
    chance = mean * (1 - mean)
    between = (spread - (k - 1) * chance) / (total - squares / total) if total and total > squares / total else 0.0
    strength = min(_STRONGEST, max(1e-3, chance / between - 1)) if between > 0 else _STRONGEST
    size = F.col("n") + F.lit(strength)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / size
    return hosts.withColumn("rate", rate).withColumn(
        "low", F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    )


def rejected_hosts(judged: DataFrame, max_rate: float = 0.9, z: float = 2.0) -> DataFrame:
    """Hosts whose failure rate is above ``max_rate`` beyond doubt, as a written table of known size."""
    return materialize(host_rates(judged, z).where(F.col("low") > max_rate).select("host"), "rejected-hosts")


def judge_documents(docs: DataFrame, max_rate: float = 0.9, z: float = 2.0) -> DataFrame:
    """Measures and verdict of each document of ``doc_id``, ``text`` and ``source``, its host.

    A document is kept if the base rules pass it and its host is not rejected.
    Rows without a source, and repeated rows, are judged like any other; a
    missing source has no verdict. Other columns are left out. Texts are
    measured once and never shuffled.
    """
    measures = quality_measures(F.col("text"))
    judged = materialize(
        docs.select("doc_id", F.col("source").cast("string").alias("host"), measures.alias("m"))
        .select("doc_id", "host", "m.*", base_failed(F.col("m")).alias("base_failed")),
        "measures",
    )
    return _with_verdict(judged, rejected_hosts(judged.withColumnRenamed("base_failed", "failed"), max_rate, z))


def _with_verdict(judged: DataFrame, rejected: DataFrame) -> DataFrame:
    bad = rejected.select("host", F.lit(True).alias("rejected"))
    return (
        judged.join(bad, "host", "left")
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull())
        .drop("rejected", "host")
    )


def keep_good_documents(docs: DataFrame, max_rate: float = 0.9, z: float = 2.0) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns.

    Texts are measured once: the rows are written with what the rules say, the
    hosts are judged from two columns of that table, and the rows are read
    from it again. No text is moved.
    """
    failed = base_failed(_let(quality_measures(F.col("doc.text")), lambda m: m))
    rows = docs.select(F.struct("*").alias("doc")).select(
        "doc", F.col("doc.source").cast("string").alias("host"), failed.alias("failed")
    )
    rows = materialize(rows, "measured")
    rejected = rejected_hosts(rows.select("host", "failed"), max_rate, z)
    return rows.where(~F.col("failed")).join(rejected, "host", "left_anti").select("doc.*")

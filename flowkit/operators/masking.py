"""Predict a masked word from the word before it.

The model is a table: for each word its most frequent successor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.operators.joins import lookup_join
from flowkit.session import materialize


def bigram_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Counts ``(prev, next, n)`` of adjacent words of a line, in lower case."""
    found = text.words(F.lower(F.col(column)), text.ASCII_WORD)
    pairs = F.arrays_zip(
        F.col("w").alias("prev"), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))).alias("next")
    )
    return (
        lines.select(found.alias("w"))
        .where(F.size("w") > 1)
        .select(F.inline(pairs).alias("prev", "next"))
        .where(F.col("next").isNotNull())
        .groupBy("prev", "next")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def best_next_word(bigrams: DataFrame) -> DataFrame:
    """The most frequent successor per word; the greater word wins a tie."""
    return bigrams.groupBy("prev").agg(F.max_by("next", F.struct("n", "next")).alias("predicted"))


def predict_masked(df: DataFrame, column: str, model: DataFrame, keep_last: int = 1) -> DataFrame:
    """Add the masked text, the predicted word and a report line.

    Blank texts drop out. A text without a known word before the mask gets an
    empty prediction.
    """
    parts = text.tokens(F.col(column))
    before = F.get(parts, F.size(parts) - (keep_last + 2))
    masked = df.where(text.has_text(F.col(column))).select(
        "*",
        text.mask_token(F.col(column), keep_last).alias("masked"),
        # A text without a word there matches nothing; keys of their own keep such texts apart.
        F.coalesce(F.lower(before), F.concat(F.lit("\0"), F.xxhash64(column).cast("string"))).alias("__before"),
    )
    return (
        masked.transform(lookup_join, model, "__before", "prev")
        .withColumn("predicted", F.coalesce("predicted", F.lit("")))
        .withColumn("report", F.concat(F.col(column), F.lit(";"), F.col("predicted")))
        .drop("__before")
    )


def two_sided_model(bigrams: DataFrame) -> DataFrame:
    """What ``predict_between`` needs of ``(prev, next, n)``: adds how often ``next`` has a successor, and the words known.

    Returns ``prev``, ``next``, ``n``, ``follows`` (pairs that begin with
    ``next``). Every word of the vocabulary occurs as a ``next``, the ones that
    never follow another in a row whose ``prev`` is NULL and ``n`` is 0.
    """
    begun = bigrams.groupBy(F.col("prev").alias("word")).agg(F.sum("n").alias("follows"))
    known = bigrams.join(begun, F.col("next") == F.col("word"), "left").select(
        "prev", "next", "n", F.coalesce("follows", F.lit(0)).cast("bigint").alias("follows")
    )
    first = begun.join(bigrams.select("next").distinct(), F.col("word") == F.col("next"), "left_anti")
    lonely = first.select(
        F.lit(None).cast("string").alias("prev"), F.col("word").alias("next"), F.lit(0).cast("bigint").alias("n"), "follows"
    )
    return known.unionByName(lonely)


def _weight(before, after, follows, size):
    """The product of both smoothed chances, but for what all candidates of a context share."""
    return ((before + 1) * (after + 1)).cast("double") / (follows + size).cast("double")


def predict_between(contexts: DataFrame, model: DataFrame) -> DataFrame:
    """The likeliest word between two others: ``before``, ``after``, ``predicted`` for each distinct pair of them.

    Of all words c of the vocabulary, the one with the greatest P(c | before)
    times P(after | c), both from pair counts with one added to each; the
    greater word wins a tie. ``model`` is what ``two_sided_model`` returns,
    and is read several times. Words that the model does not know may stand on
    either side; a NULL on either side drops out.

    Not every word is tried, and no candidate that could win is left out. The
    best word that follows ``before``, the best that precedes ``after`` and,
    of all words, the one with the fewest successors are compared first. Only
    a word that both follows and precedes can be better; the lists of both are
    in the order of what their words score on that side alone, and the one is
    read whose start, as far as a word could still win with the most frequent
    pair of the other side, is shorter.
    """
    asked = contexts.select("before", "after").where("before IS NOT NULL AND after IS NOT NULL").distinct()
    asked = materialize(asked, "contexts")
    size = model.agg(F.countDistinct("next").alias("size")).scalar()
    words = model.withColumn("size", size)
    one = F.lit(0).cast("bigint")

    def chance(before, after, follows="follows"):
        return _weight(before, after, F.col(follows), F.col("size"))

    # The best word that neither follows nor precedes any of the two: one row.
    found = F.struct(chance(one, one).alias("score"), F.col("next").alias("word"))
    rarest = words.agg(F.max(found).alias("rare")).scalar()
    pairs = words.where("prev IS NOT NULL")
    begun = words.groupBy(F.col("next").alias("w")).agg(F.first("follows").alias("begins"))
    # Per word before it, its successors; per word behind it, its predecessors; of no words but those asked for.
    wanted = {side: asked.select(F.col(side).alias("key")).distinct() for side in ("before", "after")}
    ahead = pairs.withColumn("key", F.col("prev")).join(wanted["before"], "key", "left_semi")
    behind = pairs.withColumn("key", F.col("next")).join(wanted["after"], "key", "left_semi")
    lists = {
        "before": ahead.select("key", F.col("next").alias("word"), "n", "follows", "size"),
        "after": behind.join(begun, F.col("prev") == F.col("w")).select(
            "key", F.col("prev").alias("word"), "n", F.col("begins").alias("follows"), "size"
        ),
    }
    # Read several times below.
    lists = {side: materialize(rows, f"words-{side}") for side, rows in lists.items()}
    known = asked
    for side, rows in lists.items():
        own = F.struct(chance(F.col("n"), one).alias("score"), "word", "n", "follows")
        first = rows.groupBy(F.col("key").alias(f"{side}_key")).agg(F.max(own).alias(f"{side}_best"), F.max("n").alias(f"{side}_most"))
        known = known.join(first, F.col(side) == F.col(f"{side}_key"), "left")
    alone = [F.struct(F.col(f"{side}_best.score"), F.col(f"{side}_best.word")) for side in lists]
    alone = [F.when(F.col(f"{side}_key").isNotNull(), x) for side, x in zip(lists, alone)]
    known = materialize(known.withColumn("floor", F.greatest(*alone, rarest)), "known")
    floors = known.select("before", "after", F.col("floor").alias("found"))

    # The best of either side with its count on the other one: what a word has to beat.
    both = known.where("before_key IS NOT NULL AND after_key IS NOT NULL").withColumn("size", size)
    counted = pairs.select(F.col("prev").alias("p"), F.col("next").alias("q"), F.col("n").alias("m"))
    for side, other, ends in (("before", "after", ("before_best.word", "after")), ("after", "before", ("before", "after_best.word"))):
        met = counted.toDF("p", "q", f"{other}_met")
        both = both.join(met, (F.col(ends[0]) == F.col("p")) & (F.col(ends[1]) == F.col("q")), "left").drop("p", "q")
        score = chance(F.col(f"{side}_best.n"), F.coalesce(f"{other}_met", one), f"{side}_best.follows")
        both = both.withColumn("floor", F.greatest("floor", F.struct(score.alias("score"), F.col(f"{side}_best.word").alias("word"))))
    both = materialize(both, "both")
    floors = floors.unionByName(both.select("before", "after", F.col("floor").alias("found")))

    def reach(side, other):
        """The list of a side in its order, and how much of it each context has to read."""
        rows = lists[side].join(both.select(F.col(side).alias("key")).distinct(), "key", "left_semi")
        # A little lower, as it is divided in another order.
        least = F.col("floor.score") / (F.col(f"{other}_most") + 1) * (1 - 1e-9)
        entries = rows.select(
            "key", chance(F.col("n"), one).alias("score"), F.lit(0).alias("asks"), "word", "n", "follows", F.lit(None).cast("string").alias("other")
        )
        asks = both.select(
            F.col(side).alias("key"), least.alias("score"), F.lit(1).alias("asks"), F.lit(None).cast("string").alias("word"),
            one.alias("n"), one.alias("follows"), F.col(other).alias("other"),
        )
        order = Window.partitionBy("key").orderBy(F.desc("score"), "asks").rowsBetween(Window.unboundedPreceding, 0)
        placed = entries.unionByName(asks).withColumn("place", F.sum(1 - F.col("asks")).over(order))
        entries = placed.where("asks = 0").select("key", "place", "word", "n", "follows")
        return entries, placed.where("asks = 1").select(F.col("key").alias(side), F.col("other").alias(other), F.col("place").alias(f"{side}_reach"))

    (ahead, ahead_reach), (behind, behind_reach) = reach("before", "after"), reach("after", "before")
    reached = ahead_reach.join(behind_reach, ["before", "after"]).where("before_reach > 0 AND after_reach > 0")
    for side, entries, shorter in (
        ("before", ahead, F.col("before_reach") <= F.col("after_reach")), ("after", behind, F.col("before_reach") > F.col("after_reach"))
    ):
        places = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{side}_reach"))).alias("at")
        tried = reached.where(shorter).select("before", "after", places)
        tried = tried.join(entries, (F.col(side) == F.col("key")) & (F.col("at") == F.col("place"))).withColumn("size", size)
        ends = ("word", "after") if side == "before" else ("before", "word")
        met = tried.join(counted, (F.col(ends[0]) == F.col("p")) & (F.col(ends[1]) == F.col("q")))
        score = chance(F.col("n"), F.col("m"))
        floors = floors.unionByName(met.select("before", "after", F.struct(score.alias("score"), "word").alias("found")))
    return floors.groupBy("before", "after").agg(F.max("found")["word"].alias("predicted"))


def predict_masked_between(df: DataFrame, column: str, model: DataFrame) -> DataFrame:
    """Like ``predict_masked``, with the words on both sides of the mask: the one before it and the last one, which is kept.

    A text without a word before the mask gets an empty prediction.
    """
    parts = text.tokens(F.col(column))
    size = F.size(parts)
    masked = df.where(text.has_text(F.col(column))).select(
        "*",
        text.mask_token(F.col(column)).alias("masked"),
        F.lower(F.get(parts, size - 3)).alias("__before"),
        F.lower(F.get(parts, size - 1)).alias("__after"),
    )
    found = predict_between(masked.select(F.col("__before").alias("before"), F.col("__after").alias("after")), model)
    # Texts without a word there match nothing; keys of their own keep them apart.
    own = F.coalesce(F.col("__before"), F.concat(F.lit("\0"), F.xxhash64(column).cast("string")))
    return (
        masked.withColumn("__before", own)
        .join(found, (F.col("__before") == F.col("before")) & (F.col("__after") == F.col("after")), "left")
        .withColumn("predicted", F.coalesce("predicted", F.lit("")))
        .withColumn("report", F.concat(F.col(column), F.lit(";"), F.col("predicted")))
        .drop("__before", "__after", "before", "after")
    )

"""Each group draws one value from a list, at any size of either and with any weights.

A value that occurs ``copies`` times stands for so many places in a row, but
stays one row, which knows only where its places start. Values are lined up
by their MD5: a prefix of it puts them into a fixed number of buckets of like
size, whose sums give each bucket the place it starts at. A drawn place finds
its value among the starts of its cell, a stretch of places that holds few
starts and few draws, whatever the weights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.session import materialize

BUCKET_DIGITS = 3
#: Buckets of values, and stretches of equal length that all places are cut into.
BUCKETS = 16**BUCKET_DIGITS


def value_list(df: DataFrame, column: str, ignore: str | None = None) -> DataFrame:
    """The list as ``(value, copies)``, without ignored, empty and NULL values."""
    usable = df.where(F.col(column) != "").select(F.col(column).alias("value"))
    if ignore:
        usable = usable.where(F.col("value") != ignore)
    return usable.groupBy("value").agg(F.count(F.lit(1)).alias("copies"))


def _before(*order: str):
    return Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def bucket_starts(values: DataFrame) -> DataFrame:
    """``bucket`` and ``start``, the first place of each bucket of ``(value, copies)``; ``BUCKETS`` rows at most."""
    sums = _hashed(values).groupBy("bucket").agg(F.sum("copies").alias("inside"))
    return sums.select("bucket", F.coalesce(F.sum("inside").over(_before("bucket")), F.lit(0)).alias("start"))


def _hashed(values: DataFrame) -> DataFrame:
    hashed = values.withColumn("hash", F.md5("value"))
    return hashed.withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS))


def value_starts(values: DataFrame) -> DataFrame:
    """One row ``(value, copies, start)`` per value of ``(value, copies)``: the places ``start`` to ``start + copies`` are its."""
    within = Window.partitionBy("bucket").orderBy("hash", "value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        _hashed(values)
        .withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0)))
        # At most BUCKETS rows, whatever the size of the list.
        .join(F.broadcast(bucket_starts(values)), "bucket")
        .select("value", "copies", (F.col("start") + F.col("before")).alias("start"))
    )


def draw_number(key: Column, seed: str | int) -> Column:
    """A repeatable number below 2**60, evenly spread over the keys."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def draw(
    groups: DataFrame,
    group: str,
    candidates: DataFrame,
    column: str,
    ignore: str | None = None,
    seed: str | int = 0,
    name: str | None = None,
) -> DataFrame:
    """Attach one candidate to each group, at random but repeatable by ``seed``.

    Reads the candidates when called and writes their list to the scratch folder.
    The ignored, empty and NULL candidates are left out before drawing; one
    that occurs twice is drawn twice as often. Raises if groups exist and no
    candidate does.
    """
    values = materialize(value_list(candidates, column, ignore), "values")
    return draw_weighted(groups, group, values, seed, name or column)


def _cells(values: DataFrame, per: int, width: int) -> DataFrame:
    """Per stretch of ``width`` places: the number ``base`` of its first cell, and where further cells start in it.

    A cell starts with every stretch and with every bucket of values, so none
    holds more starts than a bucket or more draws than a stretch.
    """
    starts = bucket_starts(values).select((F.col("start") * per).alias("at"))
    stretch = F.call_function("div", F.col("at"), F.lit(width)).alias("stretch")
    heads = starts.groupBy(stretch).agg(F.sort_array(F.collect_list("at")).alias("heads"))
    every = values.sparkSession.range(BUCKETS).select(F.col("id").alias("stretch")).join(heads, "stretch", "left")
    inside = F.coalesce(F.size("heads"), F.lit(0))
    base = F.col("stretch") + F.coalesce(F.sum(inside).over(_before("stretch")), F.lit(0))
    none = F.array().cast("array<bigint>")
    return every.select("stretch", base.alias("base"), F.coalesce("heads", none).alias("heads"))


def draw_weighted(groups: DataFrame, group: str, values: DataFrame, seed: str | int = 0, name: str = "value") -> DataFrame:
    """Attach one value of ``(value, copies)`` to each group, drawn ``copies`` times as often as one of a single copy.

    At random but repeatable: a hash of the group and ``seed`` picks a place.
    Values are distinct and their copies whole numbers above zero; the sum is
    read when called and stays below 2**59. Few places are cut into parts, so
    that the groups of one value spread; no value is ever copied.
    """
    size = values.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    kept = [c for c in groups.columns if c != name]
    if not size:
        missing = F.raise_error(F.lit("no candidate to draw from")).cast("string")
        return groups.select(*kept, missing.alias(name))
    per = -(-BUCKETS // size)
    width = -(-size * per // BUCKETS)
    # At most BUCKETS rows, with as many starts in all.
    cells = F.broadcast(materialize(_cells(values, per, width), "cells"))

    def placed(df: DataFrame) -> DataFrame:
        stretch = F.call_function("div", F.col("__at"), F.lit(width))
        further = F.size(F.filter("heads", lambda h: h <= F.col("__at")))
        found = df.join(cells, stretch == F.col("stretch"))
        return found.withColumn("__cell", F.col("base") + further).drop("stretch", "base", "heads")

    place = F.pmod(draw_number(F.col(group), seed), F.lit(size)) * per + F.pmod(F.xxhash64(F.col(group)), F.lit(per))
    draws = placed(groups.select(F.struct(*kept).alias("__row"), place.alias("__at")))
    starts = placed(value_starts(values).select((F.col("start") * per).alias("__at"), F.col("value").alias("__value")))
    starts = materialize(starts, "starts")
    # The value whose places go on where a cell begins.
    last = starts.groupBy("__cell").agg(F.max_by("__value", "__at").alias("__last"))
    # Twice as many cells as buckets at most.
    numbers = values.sparkSession.range(2 * BUCKETS).select(F.col("id").alias("__cell"))
    earlier = F.last("__last", True).over(_before("__cell"))
    carried = F.broadcast(numbers.join(last, "__cell", "left").select("__cell", earlier.alias("__carried")))
    both = draws.unionByName(starts, allowMissingColumns=True)
    # A start comes before the draws of its own place.
    up_to = Window.partitionBy("__cell").orderBy("__at", F.col("__value").isNull())
    current = F.last("__value", True).over(up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("__found", current).where(F.col("__row").isNotNull()).join(carried, "__cell")
    rows = [F.col("__row").getField(c).alias(c) for c in kept]
    return found.select(*rows, F.coalesce("__found", "__carried").alias(name))

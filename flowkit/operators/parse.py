"""Text rows to typed rows, with the rows that do not fit kept aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.csvline import csv_fields
from flowkit.functions.jsonrow import json_int, json_text


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def _sort_out(
    df: DataFrame, fields: Mapping[str, Column], bad: Column, keep: Sequence[str], source: str, strict: bool
) -> Parsed:
    if strict:
        text = F.coalesce(F.col(source).cast("string"), F.lit("NULL"))
        failure = F.raise_error(F.concat(F.lit("row does not fit: "), text)).cast("boolean")
        bad = F.when(bad, failure).otherwise(False)
    row = F.struct(bad.alias("__bad"), *[value.alias(name) for name, value in fields.items()])
    # Filters do not pass below inline: each row is parsed once, whatever is
    # asked of its fields afterwards.
    checked = df.select(F.col(source).alias("__source"), *keep, row.alias("__row")).select(
        "__source", *keep, F.inline(F.array("__row"))
    )
    return Parsed(
        checked.where(~F.col("__bad")).select(*fields, *keep),
        checked.where("__bad").select(F.col("__source").alias(source)),
    )


def parse_csv_lines(
    lines: DataFrame, fields: Mapping[str, str], column: str = "value", strict: bool = False
) -> Parsed:
    """CSV lines to columns by position, ``fields`` mapping names to types.

    Extra fields are dropped, missing ones are NULL. A line with a field that
    its type does not take goes to the rejects, or raises if ``strict``.
    """
    split = lines.withColumn("__fields", csv_fields(F.col(column)))
    typed = {}
    bad = F.col("__fields").isNull()
    for place, (name, kind) in enumerate(fields.items()):
        raw = F.get("__fields", F.lit(place))
        typed[name] = raw.try_cast(kind)
        bad = bad | (raw.isNotNull() & typed[name].isNull())
    return _sort_out(split, typed, bad, (), column, strict)


def parse_json_rows(
    df: DataFrame,
    fields: Mapping[str, str],
    column: str = "value",
    keep: Sequence[str] = (),
    strict: bool = False,
) -> Parsed:
    """JSON objects to ``text`` and ``int`` columns, next to the ``keep`` columns.

    Rows that are no object, lack a field or hold a bad number go to the
    rejects, or raise if ``strict``. Takes binary or text, batch or stream.
    """
    readers = {"text": json_text, "int": json_int}
    document = df.withColumn("__doc", F.try_parse_json(F.col(column).cast("string")))
    values = {name: readers[kind](F.col("__doc"), name) for name, kind in fields.items()}
    bad = F.lit(False)
    for value in values.values():
        bad = bad | value.isNull()
    return _sort_out(document, values, bad, keep, column, strict)

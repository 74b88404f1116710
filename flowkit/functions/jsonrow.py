"""Fields of a JSON object, converted the way Python's str() and int() do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _field(doc: Column, key: str, kind: str) -> Column:
    return F.try_variant_get(doc, f"$['{key}']", kind)


def _kind(doc: Column, key: str) -> Column:
    return F.schema_of_variant(_field(doc, key, "variant"))


def json_text(doc: Column, key: str) -> Column:
    """The field as text; JSON null gives ``None``, a missing key gives NULL."""
    kind = _kind(doc, key)
    text = _field(doc, key, "string")
    return F.when(kind == "VOID", "None").when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)


def json_int(doc: Column, key: str) -> Column:
    """The field as a whole number: numbers lose their fraction, text must be a
    whole number, with single ``_`` between digits. Anything else, a number of
    more than 64 bits and a missing key give NULL."""
    kind = _kind(doc, key)
    text = F.regexp_extract(_field(doc, key, "string"), r"(?U)^\s*([+-]?\d+(?:_\d+)*)\s*$", 1)
    return F.when(kind == "STRING", F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")).when(
        kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"), _field(doc, key, "bigint")
    )


def to_json_text(*columns: str | Column) -> Column:
    """A row as a JSON object that also names its null fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

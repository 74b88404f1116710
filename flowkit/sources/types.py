"""Types of text columns, found while the rows are read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowkit.session import scratch_dir

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_WHOLE = r"^[+-]?\d+$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"
_INSTANT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"

#: Types from the narrowest up, each with the pattern of its texts; what fits an earlier one fits the later ones of its kind.
TYPES = (("int", _WHOLE), ("bigint", _WHOLE), ("double", _NUMBER), ("boolean", "(?i)^(true|false)$"), ("date", _DAY), ("timestamp", _INSTANT))
_ANY = (1 << len(TYPES)) - 1


def fitting_types(text: Column) -> Column:
    """The types that a text fits, as bits in the order of ``TYPES``; NULL fits all."""
    fits = [
        F.when(text.rlike(pattern) & text.try_cast(name).isNotNull(), 1 << i).otherwise(0)
        for i, (name, pattern) in enumerate(TYPES)
    ]
    return F.when(text.isNull(), _ANY).otherwise(reduce(lambda a, b: a.bitwiseOR(b), fits))


def narrowest(bits: int | None) -> str:
    """The narrowest of the types that all values of a column fit; a column without values is text."""
    if not bits or bits == _ANY:
        return "string"
    return next(name for i, (name, _) in enumerate(TYPES) if bits >> i & 1)


def with_inferred_types(rows: DataFrame) -> DataFrame:
    """The rows with each text column cast to the narrowest type that all its values fit.

    Types are ``int``, ``bigint``, ``double``, ``boolean``, ``date`` and
    ``timestamp``, else text. The rows are read once: while they are written
    to the scratch folder, the bits of the types that fit are put together
    for every column, and the table is read back with the types found. NULL
    fits every type.
    """
    texts = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    if not texts:
        return rows
    path, seen = scratch_dir(rows.sparkSession, "typed"), Observation()
    bits = [F.bit_and(fitting_types(F.col(f"`{n}`"))).alias(f"c{i}") for i, n in enumerate(texts)]
    rows.observe(seen, *bits).write.parquet(path)
    found = {n: narrowest(seen.get[f"c{i}"]) for i, n in enumerate(texts)}
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    return written.select(*[F.col(f"`{n}`").cast(found.get(n, t)).alias(n) for n, t in rows.dtypes])

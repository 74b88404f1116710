"""One line of CSV text to its fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A field is either quoted (a doubled quote stands for one, text after the
# closing quote belongs to the field, the closing quote may be missing) or
# runs up to the next comma.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"?[^,]*+|[^,]*+)'
_QUOTED = r'^"([^"]*+(?:""[^"]*+)*+)"?(.*)$'


def _unquote(raw: Column) -> Column:
    inner = F.replace(F.regexp_extract(raw, _QUOTED, 1), F.lit('""'), F.lit('"'))
    return F.when(raw.startswith('"'), F.concat(inner, F.regexp_extract(raw, _QUOTED, 2))).otherwise(raw)


def csv_fields(line: Column) -> Column:
    """Fields of a line as text; an empty field is ``''``, an empty line has none."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return (
        F.when(line == "", F.array().cast("array<string>"))
        .when(~F.contains(line, F.lit('"')), F.split(line, ","))
        .otherwise(F.transform(raw, _unquote))
    )

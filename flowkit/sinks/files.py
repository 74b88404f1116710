"""Bounded sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowkit.sources.files import EXACT_NULL


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """Write a text column as lines, one file per task, into a new folder."""
    df.select(F.col(column).alias("value")).write.text(path, lineSep="\n")


def _texts(df: DataFrame) -> dict[str, Column]:
    return {f.name: F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() == "string"}


def write_csv(df: DataFrame, path: str, exact: bool = False) -> None:
    """CSV with a header line in every file; blanks around values are kept.

    NULL and empty text are both read back as NULL, and a value with a line
    end, which would be read back as two rows, fails the job. ``exact``
    writes every value so that ``read_csv`` with ``exact`` gives it back.
    """
    writer_options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    if exact:
        marked = {n: F.when(c.startswith("\\"), F.concat(F.lit("\\"), c)).otherwise(c) for n, c in _texts(df).items()}
        writer_options |= {"quoteAll": True, "nullValue": EXACT_NULL, "emptyValue": "", "lineSep": "\n"}
    else:
        failure = F.raise_error(F.lit("a value has a line end; write it with exact=True")).cast("string")
        marked = {n: F.when(c.rlike(r"[\r\n]"), failure).otherwise(c) for n, c in _texts(df).items()}
    (df.withColumns(marked) if marked else df).write.options(**writer_options).csv(path)


def typed_rows(df: DataFrame, schema: StructType, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows with the columns in the order and types of ``schema``, and the rows that do not fit, as they came.

    With ``strict`` there are no such rows: the first value that does not fit fails the job.
    """
    typed, bad = {}, F.lit(False)
    for f in schema.fields:
        own = F.col(f.name)
        cast = own.try_cast(f.dataType)
        unfit = own.isNotNull() & cast.isNull()
        bad = bad | unfit
        text = F.concat(F.lit(f"no {f.dataType.simpleString()} for {f.name}: "), own.cast("string"))
        typed[f.name] = F.when(unfit, F.raise_error(text).cast(f.dataType)).otherwise(cast) if strict else cast
    rows = df if strict else df.where(~bad)
    return rows.select(*[c.alias(n) for n, c in typed.items()]), df.where(bad)


def append_table(
    df: DataFrame, schema: StructType, path: str | None = None, table: str | None = None, strict: bool = True
) -> DataFrame:
    """Append to a parquet folder or a catalog table, creating it when missing.

    The columns are put into the order and types of ``schema`` first. A value
    that does not fit its type fails the job; without ``strict`` its row is
    left out, and the rows left out are returned as they came.
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path and table")
    rows, bad = typed_rows(df, schema, strict)
    writer = rows.write.mode("append").format("parquet")
    if path is not None:
        writer.save(path)
    else:
        writer.saveAsTable(table)
    return bad

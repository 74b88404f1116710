"""Bounded sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowkit.sources.records import read_records
from flowkit.sources.types import with_inferred_types


def read_lines(spark: SparkSession, path: str, skip_header: bool = False) -> DataFrame:
    """One row ``value`` per line of the files a path or glob names.

    Lines end at ``\\n``; one ``\\r`` before it is dropped. ``skip_header``
    leaves out the first line of each file, whether or not Spark splits the
    file over many tasks; all other lines stay, blank ones too.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    if skip_header:
        # Row numbers rise in the order of reading, so the least of a file's
        # first block is that of its first line.
        numbered = lines.select(
            "value",
            F.monotonically_increasing_id().alias("__row"),
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__block"),
        )
        headers = numbered.where("__block = 0").groupBy("__file").agg(F.min("__row").alias("__row"))
        lines = numbered.join(headers, ["__file", "__row"], "left_anti")
    value = F.col("value")
    cut = F.substring(value, F.lit(1), F.length(value) - 1)
    return lines.select(F.when(value.endswith("\r"), cut).otherwise(value).alias("value"))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    infer: bool = False,
    exact: bool = False,
    quoted_lines: bool = False,
) -> DataFrame:
    """CSV files with a header line each.

    Columns are text without a schema; ``infer`` gives them the narrowest type
    that all their values fit, found while the files are read (``types``). An
    empty field is NULL. ``quoted_lines`` keeps line ends inside quotes; files
    are split over tasks all the same (``records``). ``exact`` reads what
    ``sinks.files.write_csv`` wrote with it, so that empty text stays apart
    from NULL, too. Without a schema the columns have the names in the first
    line of the first file.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if not exact and not quoted_lines:
        rows = (reader.schema(schema) if schema is not None else reader).csv(path)
        return with_inferred_types(rows) if infer and schema is None else rows
    if schema is None:
        schema = StructType([StructField(n, StringType()) for n in reader.csv(path).columns])
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n"}
    if exact:
        options["nullValue"] = EXACT_NULL
    fields = [] if isinstance(schema, str) else schema.fields
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) or schema
    parsed = read_records(spark, path, skip_header=True).select(F.from_csv("value", F.lit(ddl), options).alias("row"))
    rows = parsed.select("row.*")
    if exact:
        texts = {f.name: F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType.typeName() == "string"}
        bare = {n: F.when(c.startswith("\\"), F.substring(c, 2, 2**31 - 1)).otherwise(c) for n, c in texts.items()}
        rows = rows.withColumns(bare) if bare else rows
    return with_inferred_types(rows) if infer and isinstance(schema, StructType) else rows


#: NULL in exact CSV files. Text that begins with a backslash gets another in front, so no text equals it.
EXACT_NULL = "\\N"


def read_csv_list(spark: SparkSession, paths: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV files named by a comma-separated list; types are inferred without a schema."""
    return read_csv(spark, [p.strip() for p in paths.split(",") if p.strip()], schema, infer=True)


def read_table(
    df: DataFrame,
    columns: Mapping[str, str | Column],
    where: Column | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Renamed projection of a table with its row filter.

    ``columns`` maps output names to input columns or expressions, ``where``
    and ``not_null`` speak of the input columns. Catalyst pushes both the
    projection and the filters into the scan.
    """
    if where is not None:
        df = df.where(where)
    for name in not_null:
        df = df.where(F.col(name).isNotNull())
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def group_ids(spark: SparkSession, count: int, prefix: str = "id") -> DataFrame:
    """``id0`` to ``id<count-1>`` in a column ``group_id``."""
    return spark.range(count).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("group_id"))

"""Jobs over text and CSV files, and the draw of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowkit.operators import counting, parse, side, split
from flowkit.session import materialize
from flowkit.sinks import files as sinks
from flowkit.sources import files as sources

# The columns of a users file and the types of its table.
USER_FIELDS = {
    "id": "int",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "gender": "string",
}


def run_word_count(spark: SparkSession, input: str, output: str) -> None:
    """Text files to ``word: n`` lines."""
    lines = sources.read_lines(spark, input)
    sinks.write_lines(lines.transform(counting.word_count).transform(counting.format_counts), output)


def run_split_words(spark: SparkSession, input: str, output: str) -> None:
    """Text files to three folders: ``-chars``, ``-short-words``, ``-words``."""
    stats = materialize(sources.read_lines(spark, input).transform(split.word_stats), "split")
    frames = split.split_words(stats)
    chars = frames[split.CHARS].select(F.col(split.CHARS).cast("string").alias("value"))
    sinks.write_lines(chars, f"{output}-chars")
    sinks.write_lines(frames[split.SHORT].transform(counting.format_counts), f"{output}-short-words")
    sinks.write_lines(frames[split.LONG].transform(counting.format_counts), f"{output}-words")


def run_count_lines(spark: SparkSession, input: str, output: str, factor: int = 1) -> None:
    """Text files to an exact CSV of each distinct line and ``factor`` times its count."""
    counts = sources.read_lines(spark, input).transform(counting.count_elements, "value", factor)
    sinks.write_csv(counts, output, exact=True)


def draw_groups(
    groups: DataFrame,
    group: str,
    corpora: DataFrame,
    words: DataFrame,
    ignore_corpus: str = "",
    ignore_word: str = "",
    seed: int = 0,
) -> DataFrame:
    """Each group with one corpus and one word, drawn independently.

    ``corpora`` and ``words`` have one column each.
    """
    (corpus,), (word,) = corpora.columns, words.columns
    drawn = side.draw(groups, group, corpora, corpus, ignore_corpus, f"{seed}-corpus", "corpus")
    return side.draw(drawn, group, words, word, ignore_word, f"{seed}-word", "word").select(group, "corpus", "word")


def run_draw_groups(
    spark: SparkSession,
    samples: DataFrame,
    output: str,
    num_groups: int = 1,
    ignore_corpus: str = "",
    ignore_word: str = "",
    seed: int = 0,
) -> None:
    """Draw for ``num_groups`` groups from the distinct corpora and words of a table."""
    ids = sources.group_ids(spark, num_groups)
    corpora, words = (sources.distinct_values(samples, c) for c in ("corpus", "word"))
    sinks.write_csv(draw_groups(ids, "group_id", corpora, words, ignore_corpus, ignore_word, seed), output)


def run_load_users(
    spark: SparkSession, input: str, path: str | None = None, table: str | None = None, strict: bool = True
) -> parse.Parsed:
    """CSV lines with a header per file to a typed table, appended once.

    Returns the parsed rows and the lines that did not fit; by default such a
    line fails the job.
    """
    parsed = parse.parse_csv_lines(sources.read_lines(spark, input, skip_header=True), USER_FIELDS, strict=strict)
    schema = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in USER_FIELDS.items()))
    sinks.append_table(parsed.rows, schema, path=path, table=table)
    return parsed

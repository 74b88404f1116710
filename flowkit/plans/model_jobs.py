"""Jobs that call models: price reports and masked words."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.functions import text
from flowkit.functions.text import whole_number
from flowkit.operators import masking, parse, scoring
from flowkit.session import materialize
from flowkit.sinks.files import write_lines
from flowkit.sources.files import read_csv_list, read_lines

# The price models in order of preference with the columns each
# needs, and the form of a report line.
PRICE_MODELS = {
    "all_features": [
        "Area",
        "Year",
        "MinTimeToNearestStation",
        "MaxTimeToNearestStation",
        "TotalFloorArea",
        "Frontage",
        "Breadth",
        "BuildingYear",
    ],
    "floor_area": ["Area", "Year", "TotalFloorArea"],
    "stations": ["Area", "Year", "MinTimeToNearestStation", "MaxTimeToNearestStation"],
    "no_features": ["Area", "Year"],
}
REPORT = "True Price %s, Predicted Price %s"


def price_report(scored: DataFrame, true_price: str = "TradePrice", predicted: str = "prediction") -> DataFrame:
    """One line ``value`` per scored row."""
    prices = whole_number(F.col(true_price)), whole_number(F.col(predicted))
    return scored.select(F.format_string(REPORT, *prices).alias("value"))


def run_price_report(
    spark: SparkSession,
    input: str,
    output: str,
    model_factory: Callable | None = None,
    model_path: str | None = None,
    schema: str | None = None,
) -> parse.Parsed:
    """Comma-separated list of CSV files to report lines.

    Models come from ``model_factory`` or from pickle files under
    ``model_path``. Rows without the columns of any model are returned apart.
    """
    if (model_factory is None) == (model_path is None):
        raise ValueError("give exactly one of model_factory and model_path")
    if model_path is not None:
        model_factory = scoring.models_from_files(model_path, list(PRICE_MODELS))
    scored = scoring.route_and_score(read_csv_list(spark, input, schema), PRICE_MODELS, model_factory)
    write_lines(price_report(scored.rows), output)
    return scored


def train_next_word(lines: DataFrame, column: str = "value") -> DataFrame:
    """Most frequent successor per word, written out: it is the model."""
    return materialize(masking.best_next_word(masking.bigram_counts(lines, column)), "next-word")


def run_masked_words(
    spark: SparkSession,
    input: str,
    output: str,
    model: DataFrame | None = None,
    model_factory: Callable | None = None,
    max_batch: int | None = None,
) -> None:
    """Text files to ``text;word`` lines, the word being predicted for the mask.

    ``model`` is a table of successors; ``model_factory`` loads, in a task, a
    function from masked texts to words instead, called with up to
    ``max_batch`` texts.
    """
    if (model is None) == (model_factory is None):
        raise ValueError("give exactly one of model and model_factory")
    lines = read_lines(spark, input)
    if model is not None:
        report = masking.predict_masked(lines, "value", model)
    else:
        masked = lines.where(text.has_text(F.col("value"))).withColumn("masked", text.mask_token(F.col("value")))
        words = scoring.batch_infer(masked, "masked", model_factory, "string", max_batch, "predicted")
        report = words.select(F.concat("value", F.lit(";"), F.coalesce("predicted", F.lit(""))).alias("report"))
    write_lines(report, output, column="report")

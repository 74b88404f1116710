"""Routing to models, masking and prediction."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.catalog.registry import query, table
from flowkit.functions import text
from flowkit.operators import fitting, masking, scoring
from flowkit.plans import model_jobs
from flowkit.session import materialize, scratch_dir
from flowkit.sinks.files import write_csv
from flowkit.sources.files import read_csv_list

# Linear price models, one file each.
_MODEL_FOLDER = Path(__file__).parent / "price_models"
# Parts as properties: columns are missing by brand and type.
_PROPERTIES = {
    "Area": "p_size",
    "Year": "p_partkey % 50",
    "MinTimeToNearestStation": "CASE WHEN p_type <> 'ECONOMY' THEN p_size % 7 END",
    "MaxTimeToNearestStation": "CASE WHEN p_type <> 'ECONOMY' THEN p_size % 11 END",
    "TotalFloorArea": "CASE WHEN p_brand < 'Brand#2' THEN p_size * 3 END",
    "Frontage": "p_size % 5",
    "Breadth": "p_size % 3",
    "BuildingYear": "p_partkey % 9",
    "TradePrice": "p_retailprice",
}
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_TOKENS = rf"string_split_regex(regexp_replace(text, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_SPACE}+')"
_MASKED = f"""
    SELECT conv_id, turn, text, tok, len(tok) AS size,
           array_to_string(list_concat(list_slice(tok, 1, greatest(len(tok) - 2, 0)), ['[MASK]', tok[len(tok)]]), ' ')
           AS masked
    FROM (SELECT *, {_TOKENS} AS tok FROM conversations WHERE regexp_matches(text, '[^\\s\\x1c-\\x1f\\x85\\p{{Z}}]'))
"""


def _formula(name: str) -> str:
    model = json.loads((_MODEL_FOLDER / f"{name}.json").read_text())
    return " + ".join([str(model["intercept"]), *[f"({w}) * {c}" for c, w in model["coefficients"].items()]])


def _routed(value) -> str:
    cases = " ".join(
        f"WHEN {' AND '.join(f'{c} IS NOT NULL' for c in columns)} THEN {value(name)}"
        for name, columns in model_jobs.PRICE_MODELS.items()
    )
    return f"CASE {cases} END"


@query(f"""
    SELECT printf('True Price %.0f, Predicted Price %.0f', TradePrice, prediction) AS value
    FROM (
        SELECT TradePrice, ({_routed(_formula)})::DOUBLE AS prediction
        FROM (SELECT {", ".join(f"{e} AS {c}" for c, e in _PROPERTIES.items())} FROM part)
    )
""")
def route_and_score(spark: SparkSession, folder: str) -> DataFrame:
    """Properties in two lists of CSV files, scored by models from files and reported."""
    rows = table(spark, folder, "part").selectExpr(*[f"{e} AS {c}" for c, e in _PROPERTIES.items()])
    paths = [scratch_dir(spark, "properties") for _ in range(2)]
    cheap = F.coalesce(F.col("TradePrice") < 1000, F.lit(False))
    for path, part in zip(paths, (rows.where(cheap), rows.where(~cheap))):
        write_csv(part, path)
    schema = ", ".join(f"{c} double" for c in _PROPERTIES)
    loaded = read_csv_list(spark, ",".join(paths), schema)
    names = list(model_jobs.PRICE_MODELS)
    factory = scoring.models_from_files(f"{_MODEL_FOLDER}/", names, ".json", scoring.linear_model_reader())
    scored = scoring.route_and_score(loaded, model_jobs.PRICE_MODELS, factory).rows
    return model_jobs.price_report(scored)


@query(f"SELECT conv_id, turn, masked FROM ({_MASKED})")
def mask_last_word(spark: SparkSession, folder: str) -> DataFrame:
    talk = table(spark, folder, "conversations").where(text.has_text(F.col("text")))
    return talk.select("conv_id", "turn", text.mask_token(F.col("text")).alias("masked"))


@query(f"""
    WITH words AS (
        SELECT regexp_extract_all(lower(line), '[a-z'']+') AS w
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    ),
    pairs AS (
        SELECT p.a AS prev, p.b AS next FROM (
            SELECT unnest(list_transform(range(1, len(w)), lambda i: {{'a': w[i], 'b': w[i + 1]}})) AS p
            FROM words WHERE len(w) > 1
        )
    ),
    best AS (
        SELECT prev, next FROM (
            SELECT prev, next, row_number() OVER (PARTITION BY prev ORDER BY count(*) DESC, next DESC) AS place
            FROM pairs GROUP BY prev, next
        ) WHERE place = 1
    )
    SELECT conv_id, turn, masked, coalesce(next, '') AS predicted, text || ';' || coalesce(next, '') AS report
    FROM ({_MASKED}) LEFT JOIN best ON size >= 3 AND lower(tok[size - 2]) = prev
""")
def masked_predict(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("text")
    lines = texts.select(F.explode(text.lines_of(F.col("text"))).alias("value"))
    model = model_jobs.train_next_word(lines)
    talk = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return masking.predict_masked(talk, "text", model).drop("text")


@query(f"""
    WITH lines AS (
        SELECT regexp_extract_all(lower(line), '[a-z'']+') AS w
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    ),
    pairs AS (
        SELECT p.a AS prev, p.b AS next, count(*) AS n FROM (
            SELECT unnest(list_transform(range(1, len(w)), lambda i: {{'a': w[i], 'b': w[i + 1]}})) AS p
            FROM lines WHERE len(w) > 1
        ) GROUP BY ALL
    ),
    vocabulary AS (
        SELECT word, coalesce(sum(n), 0) AS follows
        FROM (SELECT prev AS word, n FROM pairs UNION ALL SELECT next, 0 FROM pairs) GROUP BY word
    ),
    masked AS (SELECT *, lower(tok[size - 2]) AS before, lower(tok[size]) AS after FROM ({_MASKED})),
    contexts AS (SELECT DISTINCT before, after FROM masked WHERE size >= 3),
    best AS (
        SELECT before, after, word FROM contexts, vocabulary
        LEFT JOIN pairs p ON p.prev = before AND p.next = word LEFT JOIN pairs q ON q.prev = word AND q.next = after
        QUALIFY row_number() OVER (PARTITION BY before, after ORDER BY
            ((coalesce(p.n, 0) + 1) * (coalesce(q.n, 0) + 1))::DOUBLE
            / (follows + (SELECT count(*) FROM vocabulary))::DOUBLE DESC, word DESC) = 1
    )
    SELECT conv_id, turn, masked, coalesce(word, '') AS predicted, text || ';' || coalesce(word, '') AS report
    FROM masked LEFT JOIN best ON size >= 3 AND masked.before = best.before AND masked.after = best.after
""")
def masked_two_sided(spark: SparkSession, folder: str) -> DataFrame:
    """Words for the masks by the words on both sides of them."""
    texts = table(spark, folder, "documents").select("text")
    lines = texts.select(F.explode(text.lines_of(F.col("text"))).alias("value"))
    model = materialize(masking.two_sided_model(materialize(masking.bigram_counts(lines), "bigrams")), "two-sided")
    talk = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return masking.predict_masked_between(talk, "text", model).drop("text")


@query("""
    WITH parts AS (
        SELECT p_partkey, p_size::DOUBLE AS x, CASE WHEN p_type <> 'ECONOMY' THEN (p_partkey % 50)::DOUBLE END AS z,
               p_retailprice AS y, CASE WHEN p_type <> 'ECONOMY' THEN 'both' ELSE 'size' END AS route
        FROM part
    ),
    sums AS (
        SELECT route, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, var_pop(z) AS zz,
               covar_pop(x, z) AS xz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy
        FROM parts GROUP BY route
    ),
    models AS (
        SELECT *, CASE WHEN route = 'both' THEN (xy * zz - zy * xz) / (xx * zz - xz * xz) ELSE xy / xx END AS a,
               CASE WHEN route = 'both' THEN (zy * xx - xy * xz) / (xx * zz - xz * xz) ELSE 0 END AS b
        FROM sums
    )
    SELECT p_partkey, route, round(my + a * (x - mx) + coalesce(b * (z - mz), 0), 3) AS prediction
    FROM parts JOIN models USING (route)
""")
def fit_route_models(spark: SparkSession, folder: str) -> DataFrame:
    """Price models fitted per route, written by name, loaded by the tasks and used."""
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey", "p_size AS size", "IF(p_type <> 'ECONOMY', p_partkey % 50, NULL) AS age", "p_retailprice AS price"
    )
    routes = {"both": ["size", "age"], "size": ["size"]}
    path = f"{scratch_dir(spark, 'models')}/"
    fitting.write_models(fitting.fit_routes(parts, routes, "price"), path)
    factory = scoring.models_from_files(path, list(routes), ".json", scoring.linear_model_reader())
    scored = scoring.route_and_score(parts, routes, factory).rows
    return scored.select("p_partkey", "route", F.round("prediction", 3).alias("prediction"))


def _text_formula() -> str:
    model = json.loads((_MODEL_FOLDER / "text_length.json").read_text())
    counts = [f"{w} * (length(text) - length(replace(text, '{p}', '')))" for p, w in model["counts"].items()]
    return " + ".join([str(model["intercept"]), f"{model['per_character']} * length(text)", *counts])


@query(f"SELECT conv_id, turn, ({_text_formula()})::DOUBLE AS inference FROM ({_MASKED})")
def keyed_batch_infer(spark: SparkSession, folder: str) -> DataFrame:
    """A model from a file that sees up to 64 texts a call; the keys stay beside them."""
    talk = table(spark, folder, "conversations").where(text.has_text(F.col("text")))
    factory = scoring.models_from_files(f"{_MODEL_FOLDER}/", ["text_length"], ".json", scoring.text_model_reader())
    scored = scoring.batch_infer(talk, "text", lambda: factory("text_length"), "double", max_batch=64)
    return scored.select("conv_id", "turn", "inference")

"""Model calls on batches of rows.

Only the columns a model reads cross into Python, as Arrow batches; the others
stay in the JVM beside them. A model is loaded once per task.
"""

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.operators.parse import Parsed
from flowkit.operators.split import all_present, with_route

Model = Callable[[pd.DataFrame], Sequence[float]]


def route_and_score(
    df: DataFrame,
    routes: Mapping[str, Sequence[str]],
    model_factory: Callable[[str], Model],
    prediction: str = "prediction",
    strict: bool = False,
) -> Parsed:
    """Score each row with the first model whose columns it has.

    ``routes`` maps model names to the columns they need, in order of
    preference. ``model_factory`` loads a model by name inside a task. One
    pass over the data serves all models. Rows that no model takes go to the
    rejects, or raise if ``strict``.
    """
    needed = {name: list(columns) for name, columns in routes.items()}
    features = list(dict.fromkeys(c for columns in needed.values() for c in columns))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        models = {}
        for batch in batches:
            scores = pd.Series(np.nan, index=batch.index, dtype="float64")
            for name, part in batch.groupby("route"):
                if name not in models:
                    models[name] = model_factory(name)
                scores.loc[part.index] = np.asarray(models[name](part[needed[name]]), dtype="float64")
            yield scores

    score = F.pandas_udf(predict, "double")
    routed = df.transform(with_route, {name: all_present(columns) for name, columns in needed.items()})
    lost = F.col("route").isNull()
    if strict:
        routed = routed.withColumn(
            "route", F.when(lost, F.raise_error(F.lit("no model takes this row"))).otherwise(F.col("route"))
        )
    inputs = F.struct("route", *[F.col(c).cast("double").alias(c) for c in features])
    return Parsed(routed.where(~lost).withColumn(prediction, score(inputs)), routed.where(lost).drop("route"))


def batch_infer(
    df: DataFrame,
    column: str,
    model_factory: Callable[[], Callable[[pd.Series], Sequence]],
    result_type: str,
    max_batch: int | None = None,
    prediction: str = "inference",
) -> DataFrame:
    """Model output beside its input; all other columns serve as the key.

    ``max_batch`` bounds how many examples one model call sees.
    """

    def infer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for batch in batches:
            step = max_batch or max(len(batch), 1)
            found = [list(model(batch.iloc[i : i + step])) for i in range(0, len(batch), step)]
            yield pd.Series([x for part in found for x in part], index=batch.index, dtype="object")

    return df.withColumn(prediction, F.pandas_udf(infer, result_type)(F.col(column)))


def open_file(path: str) -> BinaryIO:
    """Open a file by its path or URI, in whatever file system that names."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(place)


def models_from_files(
    model_path: str,
    names: Sequence[str],
    suffix: str = ".pickle",
    read: Callable[[BinaryIO], object] | None = None,
) -> Callable[[str], Model]:
    """A model factory for files ``model_path + name + suffix``.

    The path, or URI, lies in a file system that every executor reaches; a
    task opens the file when it first needs the model. ``read`` makes a model of an open
    file; without it the file is unpickled, which runs code from the file: load
    only models you trust. A model is a function of a frame or has ``predict``.
    """
    known = frozenset(names)

    def load(name: str):
        import pickle

        if name not in known:
            raise KeyError(name)
        with open_file(f"{model_path}{name}{suffix}") as file:
            model = read(file) if read else pickle.load(file)
        return getattr(model, "predict", model)

    return load


def text_model_reader() -> Callable[[BinaryIO], Callable[[pd.Series], np.ndarray]]:
    """Reads a model of texts from JSON: ``intercept``, ``per_character``, and weights of ``counts`` of strings."""

    def read(file):
        import json

        spec = json.load(file)

        def predict(texts: pd.Series) -> np.ndarray:
            score = spec["intercept"] + spec["per_character"] * texts.str.len().to_numpy(dtype="float64")
            for part, weight in spec["counts"].items():
                score += weight * texts.str.count(part).to_numpy(dtype="float64")
            return score

        return predict

    return read


def linear_model_reader() -> Callable[[BinaryIO], Model]:
    """Reads a linear model from JSON with ``intercept`` and ``coefficients``."""

    def read(file):
        import json

        spec = json.load(file)
        weights = spec["coefficients"].items()
        return lambda rows: spec["intercept"] + sum(rows[c].to_numpy() * w for c, w in weights)

    return read

"""Linear models fitted per route, from sums that one pass over the rows gives."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.operators.split import all_present, with_route
from flowkit.sources.messagelog import file_system

#: What is left of a column's variance, once the columns before it are known, for it to count.
_LEFT = 1e-9


def solve(covariances: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The weights of least squares, by Cholesky steps; a column that follows from those before it gets none."""
    size = len(target)
    factor, used = np.zeros((size, size)), []
    for i in range(size):
        for j in used:
            factor[i, j] = (covariances[i, j] - factor[i, used] @ factor[j, used]) / factor[j, j]
        left = covariances[i, i] - factor[i, used] @ factor[i, used]
        if left > _LEFT * covariances[i, i]:
            factor[i, i] = np.sqrt(left)
            used.append(i)
    own = factor[np.ix_(used, used)]
    weights = np.zeros(size)
    if used:
        weights[used] = np.linalg.solve(own.T, np.linalg.solve(own, target[used]))
    return weights


def fit_routes(df: DataFrame, routes: Mapping[str, Sequence[str]], target: str) -> dict[str, dict]:
    """A linear model of ``target`` for each route: ``intercept``, ``coefficients`` and the number of ``rows``.

    ``routes`` maps names to the columns they need, in order of preference; a
    row teaches the first model whose columns it has, as ``route_and_score``
    would let that model score it. Rows without a target, or with a number
    that is not finite, teach nothing. One pass adds up means and covariances of
    all columns per route, and one row per route comes to the driver. Routes
    without rows have no model. Columns that follow from others count nothing.
    """
    columns = list(dict.fromkeys(c for needed in routes.values() for c in needed))
    routed = df.transform(with_route, {n: all_present(list(c)) if c else F.lit(True) for n, c in routes.items()})
    values = {c: F.col(c).cast("double") for c in (*columns, target)}
    known = {c: F.when(F.abs(v) < F.lit(float("inf")), v) for c, v in values.items()}
    plain = routed.where(F.col("route").isNotNull() & known[target].isNotNull())
    for name, needed in routes.items():
        finite = [known[c].isNotNull() for c in needed]
        for ok in finite:
            plain = plain.where((F.col("route") != name) | ok)
    pairs = [(a, b) for i, a in enumerate(columns) for b in (*columns[i:], target)]
    sums = [F.avg(known[c]).alias(f"m{i}") for i, c in enumerate((*columns, target))]
    sums += [F.covar_pop(known[a], known[b]).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    found = {}
    for row in plain.groupBy("route").agg(F.count(F.lit(1)).alias("rows"), *sums).collect():
        own = list(routes[row.route])
        means = {c: row[f"m{i}"] for i, c in enumerate((*columns, target))}
        both = {p: row[f"c{i}"] for i, p in enumerate(pairs)}
        between = np.array([[both.get((a, b), both.get((b, a))) for b in own] for a in own], float).reshape(len(own), len(own))
        weights = solve(between, np.array([both[a, target] for a in own], float))
        intercept = means[target] - sum(w * means[c] for w, c in zip(weights, own))
        found[row.route] = {
            "intercept": float(intercept),
            "coefficients": {c: float(w) for c, w in zip(own, weights)},
            "rows": row.rows,
        }
    return found


def write_models(models: Mapping[str, dict], path: str, suffix: str = ".json") -> None:
    """One file ``path + name + suffix`` per model, for ``scoring.models_from_files`` with ``linear_model_reader``."""
    for name, model in models.items():
        system, place = file_system(f"{path}{name}{suffix}")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place) as out:
            out.write(json.dumps(model).encode())

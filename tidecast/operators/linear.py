"""Least squares of every series as one aggregation.

The fit needs only means and covariances, which Spark combines before the shuffle,
so a series of any length costs one row per task. Only the small system of each
series is solved in Python.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.learners import share
from tidecast.operators.skew import join_series
from tidecast.session import materialize
from tidecast.spec import PanelSpec


def moments(df: DataFrame, spec: PanelSpec, features: list[str]) -> DataFrame:
    """Means, covariances and rows of each series, over its complete rows."""
    complete = F.lit(True)
    for c in [*features, spec.target]:
        complete = complete & F.col(c).isNotNull()
    columns = [*features, spec.target]
    used = {c: F.when(complete, F.col(c).cast("float").cast("double")) for c in columns}
    pairs = [
        F.covar_pop(used[a], used[b]) for a, b in combinations_with_replacement(columns, 2)
    ]
    return df.groupBy(spec.grain).agg(
        F.count(used[spec.target]).alias("_used"),
        F.array(*[F.avg(used[c]) for c in columns]).alias("_mean"),
        F.array(*pairs).alias("_cov"),
    )


def solve(sums: DataFrame, spec: PanelSpec, width: int) -> DataFrame:
    """Intercept and coefficients of each series from its moments."""
    schema = T.StructType([
        sums.schema[spec.grain],
        T.StructField("_coef", T.ArrayType(T.DoubleType())),
        T.StructField("_importance", T.ArrayType(T.DoubleType())),
        T.StructField("MODEL_BINARY", T.BinaryType()),
    ])
    upper = np.triu_indices(width + 1)

    def one(used, mean, cov):
        if not used:
            return None, None, None
        square = np.zeros((width + 1, width + 1))
        square[upper] = cov
        square = np.triu(square) + np.triu(square, 1).T
        spread = np.sqrt(np.maximum(np.diag(square)[:width], 0))
        # Correlations, so that features of very different scale count alike.
        scale = np.where(spread > 0, spread, 1.0)
        related = square[:width, :width] / np.outer(scale, scale)
        beta = np.linalg.pinv(related, hermitian=True) @ (square[:width, width] / scale) / scale
        coef = np.concatenate([[mean[width] - beta @ mean[:width]], beta])
        return coef, share(np.abs(beta) * spread), coef.tobytes()

    def run(batches):
        for pdf in batches:
            solved = [one(*row) for row in zip(pdf["_used"], pdf["_mean"], pdf["_cov"])]
            out = pd.DataFrame(solved, columns=["_coef", "_importance", "MODEL_BINARY"], dtype=object)
            out.insert(0, spec.grain, pdf[spec.grain].to_numpy())
            yield out

    return sums.mapInPandas(run, schema)


def fitted_value(features: list[str]):
    """Prediction of a row that carries ``_coef``."""
    value = F.col("_coef")[0]
    for i, c in enumerate(features):
        value = value + F.col("_coef")[i + 1] * F.col(c).cast("float").cast("double")
    return value


def coefficients(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """``_coef`` of each series: intercept first, then one entry per feature.

    Stored, so that a join knows how small it is and leaves the rows where they are.
    """
    features = spec.features(df)
    solved = solve(moments(df, spec, features), spec, len(features))
    return materialize(solved.select(spec.grain, "_coef"), "coefficients")


def predict_linear(rows: DataFrame, coef: DataFrame, spec: PanelSpec) -> DataFrame:
    """Predictions as a join and an expression, without Python."""
    features = spec.features(rows)
    return join_series(rows, coef, spec.grain).select(*spec.roles, fitted_value(features).alias("PREDICTION"))


def fit_linear(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """One model row per series: bytes, metrics, status."""
    features = spec.features(df)
    coef = materialize(solve(moments(df, spec, features), spec, len(features)), "coefficients")
    error = F.col(spec.target).cast("float").cast("double") - fitted_value(features)
    scored = join_series(df, coef.drop("MODEL_BINARY", "_importance"), spec.grain)
    quality = scored.groupBy(spec.grain).agg(
        F.avg(F.abs(error)).alias("TRAIN_MAE"),
        F.sqrt(F.avg(error * error)).alias("TRAIN_RMSE"),
        F.count("*").alias("TRAIN_ROWS"),
    )
    names = F.array(*[F.lit(c) for c in features]).cast("array<string>")
    metrics = F.struct(
        "TRAIN_MAE",
        "TRAIN_RMSE",
        "TRAIN_ROWS",
        F.map_from_arrays(names, "_importance").alias("FEATURE_IMPORTANCES"),
    )
    failed = F.col("MODEL_BINARY").isNull()
    return coef.join(quality, spec.grain).select(
        spec.grain,
        "MODEL_BINARY",
        F.when(~failed, metrics).alias("METRICS"),
        F.when(failed, "error").otherwise("ok").alias("STATUS"),
        F.when(failed, "no complete row").alias("ERROR"),
    )

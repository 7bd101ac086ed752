"""One model per series, and the table of models."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.learners import Learner
from tidecast.operators.partial import METRICS, fit_merged, fit_schema
from tidecast.operators.skew import long_series
from tidecast.session import MAX_TASK_CELLS, MAX_TASK_ROWS, task_count
from tidecast.spec import PanelSpec

# Fits series that fit a task: (rows, spec, learner) -> one row per series, as ``fit_schema`` has it.
FitShort = Callable[[DataFrame, PanelSpec, Learner], DataFrame]
# Rows of short series that a learner with ``fit_many`` gets at a time, on average.
ROWS_TOGETHER = 16_384


def summarize(y: np.ndarray, pred: np.ndarray, features: list[str], importances) -> dict:
    """In-sample errors, row count and importances of one fit."""
    miss = y.astype(float) - pred
    return {
        "TRAIN_MAE": float(np.nanmean(np.abs(miss))),
        "TRAIN_RMSE": float(np.sqrt(np.nanmean(miss**2))),
        "TRAIN_ROWS": len(y),
        "FEATURE_IMPORTANCES": {c: float(v) for c, v in zip(features, importances)},
    }


def fit_one(X: np.ndarray, y: np.ndarray, learner: Learner, features: list[str], fitted=None) -> dict:
    """Model, metrics and status of one series in order; a failure becomes an error. ``fitted`` is
    what the learner's ``fit`` gave, if it has been called."""
    try:
        blob, importances = fitted or learner.fit(X, y)
        pred = learner.predict(learner.load(blob), X)
        metrics = summarize(y, pred, features, importances)
        return {"MODEL_BINARY": blob, "METRICS": metrics, "STATUS": "ok", "ERROR": None}
    except Exception as problem:
        error = f"{type(problem).__name__}: {problem}"
        return {"MODEL_BINARY": None, "METRICS": None, "STATUS": "error", "ERROR": error}


def fit_groups(df: DataFrame, spec: PanelSpec, learner: Learner, rows: int = 0) -> DataFrame:
    """Fit series that fit a task, of a table of so many ``rows``. A failing series becomes an
    error row, not a failed job. A learner with ``fit_many`` gets several short series at a time."""
    features = spec.features(df)
    ordering = [spec.grain, spec.time, *features, spec.target]

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ordering, kind="stable")
        grain, X = pdf[spec.grain].to_numpy(), pdf[features].to_numpy(np.float32)
        y = pdf[spec.target].to_numpy(np.float32)
        ends = np.append((grain[1:] != grain[:-1]).nonzero()[0] + 1, len(grain))
        series = [(X[i:j], y[i:j]) for i, j in zip(np.append(0, ends[:-1]), ends)]
        fitted = [None] * len(series)
        if len(series) > 1:
            try:
                fitted = learner.fit_many(series)
            except Exception:  # one by one then, so that only the failing ones fail
                pass
        found = [fit_one(*one, learner, features, known) for one, known in zip(series, fitted)]
        return pd.DataFrame([{spec.grain: grain[j - 1]} | one for j, one in zip(ends, found)])

    tasks = task_count(df.sparkSession, rows)
    dealt, key = spec.model_input(df), spec.grain
    if rows and hasattr(learner, "fit_many"):
        key = "_together"
        number = F.pmod(F.xxhash64(spec.grain), F.lit(max(tasks, rows // ROWS_TOGETHER)))
        dealt = dealt.withColumn(key, number)
    return dealt.repartition(tasks, key).groupBy(key).applyInPandas(fit, fit_schema(df, spec))


def fit_models(
    df: DataFrame,
    spec: PanelSpec,
    learner: Learner,
    run_id: str,
    model_version: str,
    trained_at: dt.datetime,
    max_task_rows: int | None = None,
    fit_short: FitShort | None = None,
) -> DataFrame:
    """The models of one run: one row per series of ``df``.

    ``trained_at`` is an argument so that a rerun gives the same table. A series of more than
    ``max_task_rows`` rows, by default as many as hold MAX_TASK_CELLS values of features, is fitted
    by the ``fit_large`` of its learner, or by many tasks if its learner's states can be merged. A
    learner with neither gets the whole series in one task, which WARNING tells. ``fit_short`` fits the other series; if it is given, a learner with
    ``fit_panel`` uses that for long series only.
    """
    df = df.filter(F.col(spec.grain).isNotNull())
    if max_task_rows is None:
        max_task_rows = min(MAX_TASK_ROWS, MAX_TASK_CELLS // max(1, len(spec.features(df))))
    if hasattr(learner, "fit_panel") and fit_short is None:
        fitted = learner.fit_panel(df, spec)
    else:
        fitted = _fit_by_size(df, spec, learner, max_task_rows, fit_short or fit_groups)
    if "WARNING" not in fitted.columns:
        fitted = fitted.withColumn("WARNING", F.lit(None).cast("string"))
    names = F.array(*[F.lit(c) for c in spec.features(df)]).cast("array<string>")
    return fitted.select(
        spec.grain,
        F.lit(run_id).alias("RUN_ID"),
        F.lit(model_version).alias("MODEL_VERSION"),
        F.lit(learner.name).alias("ALGORITHM"),
        names.alias("FEATURE_COLS"),
        "MODEL_BINARY",
        F.lit(trained_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("TRAINED_AT"),
        F.col("METRICS").cast(METRICS).alias("METRICS"),
        "STATUS",
        "ERROR",
        "WARNING",
    )


def _fit_by_size(df, spec, learner, max_task_rows, fit_short):
    """Short series inside tasks; series beyond ``max_task_rows`` as Spark aggregations."""
    large, most_parts, total = long_series(df, spec.grain, max_task_rows)
    if fit_short is fit_groups:
        fit_short = functools.partial(fit_groups, rows=total)
    if not most_parts:
        return fit_short(df, spec, learner)
    if hasattr(learner, "merge"):
        small = fit_short(df.join(large, spec.grain, "left_anti"), spec, learner)
        rest = df.join(large.select(spec.grain), spec.grain, "left_semi")
        return small.unionByName(fit_merged(rest, spec, learner, max_task_rows))
    if hasattr(learner, "fit_large") or hasattr(learner, "fit_panel"):
        small = fit_short(df.join(large, spec.grain, "left_anti"), spec, learner)
        rest = df.join(large.select(spec.grain), spec.grain, "left_semi")
        if hasattr(learner, "fit_large"):
            return small.unionByName(learner.fit_large(rest, spec, max_task_rows))
        return small.unionByName(learner.fit_panel(rest, spec).select(small.columns))
    note = F.concat(
        F.lit(f"fitted in one task: learner '{learner.name}' has no fit_large and the series has "),
        F.col("_rows"),
        F.lit(f" rows, more than {max_task_rows}"),
    )
    notes = large.select(spec.grain, note.alias("WARNING"))
    return fit_short(df, spec, learner).join(notes, spec.grain, "left")


def metrics_long(models: DataFrame, spec: PanelSpec) -> DataFrame:
    """One row per series and feature with its importance."""
    return models.select(
        spec.grain, F.explode("METRICS.FEATURE_IMPORTANCES").alias("FEATURE", "IMPORTANCE")
    )

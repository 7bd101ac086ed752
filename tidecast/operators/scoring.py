"""Scoring: each row by the model of its own series."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.learners import Boosted, Learner, Linear
from tidecast.operators.ranking import rank_in_time
from tidecast.operators.skew import in_parts
from tidecast.session import MAX_TASK_ROWS, materialize
from tidecast.spec import PanelSpec

POLICIES = ("drop", "error")


def usable_models(models: DataFrame) -> DataFrame:
    return models.filter(F.col("MODEL_BINARY").isNotNull())


def missing_model_rows(rows: DataFrame, models: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows whose series has no usable model."""
    return rows.join(usable_models(models).select(spec.grain), spec.grain, "left_anti")


def score(
    rows: DataFrame,
    models: DataFrame,
    spec: PanelSpec,
    on_missing_model: str = "drop",
    learners: tuple[Learner, ...] = (Linear(), Boosted()),
    max_task_rows: int = MAX_TASK_ROWS,
) -> DataFrame:
    """(grain, time, target, PREDICTION), one row per input row that has a model.

    ``on_missing_model='error'`` fails on a series without a model instead of leaving
    it out. ``models`` must hold one model per series. A series longer than
    ``max_task_rows`` is cut into parts that are scored by different tasks, each with
    its copy of the model.
    """
    if on_missing_model not in POLICIES:
        raise ValueError(f"on_missing_model must be one of {POLICIES}")
    has_target = spec.target in rows.columns
    if not has_target:
        rows = rows.withColumn(spec.target, F.lit(None).cast("double"))
    rows = rows.filter(F.col(spec.grain).isNotNull())
    blobs = usable_models(models).select(spec.grain, "ALGORITHM", "FEATURE_COLS", "MODEL_BINARY")
    short, spread, large, tasks = in_parts(rows, spec.grain, max_task_rows)
    scored = _score_groups(short, blobs, [spec.grain], spec, on_missing_model, learners, tasks)
    if spread is not None:
        part_numbers = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")
        copies = blobs.join(large.select(spec.grain, part_numbers), spec.grain)
        keys = [spec.grain, "_part"]
        scored = scored.unionByName(_score_groups(spread, copies, keys, spec, on_missing_model, learners, tasks))
    return scored if has_target else scored.drop(spec.target)


def _score_groups(rows, blobs, keys, spec, on_missing_model, learners, tasks):
    schema = T.StructType([
        rows.schema[spec.grain],
        rows.schema[spec.time],
        rows.schema[spec.target],
        T.StructField("PREDICTION", T.DoubleType()),
    ])
    by_name = {learner.name: learner for learner in learners}
    outputs = [spec.grain, spec.time, spec.target]

    def answer(part: pa.Table, values: np.ndarray) -> pa.Table:
        return part.select(outputs).append_column("PREDICTION", pa.array(values, pa.float64(), from_pandas=True))

    def predict(part: pa.Table, model: pa.Table) -> pa.Table:
        if not model.num_rows and part.num_rows and on_missing_model == "error":
            raise ValueError(f"series {part[spec.grain][0].as_py()} has rows to score but no model")
        if model.num_rows > 1 and part.num_rows:
            raise ValueError(f"series {part[spec.grain][0].as_py()} has {model.num_rows} models to choose from")
        if not model.num_rows or not part.num_rows:
            return answer(part.slice(0, 0), np.empty(0))
        part = part.sort_by(spec.time)
        stored = model.slice(0, 1).to_pylist()[0]
        learner = by_name[stored["ALGORITHM"]]
        X = np.column_stack([part[c].to_numpy() for c in stored["FEATURE_COLS"]])
        return answer(part, learner.predict(learner.load(stored["MODEL_BINARY"]), X))

    floats = [F.col(c).cast("float").alias(c) for c in spec.features(rows) if c != "_part"]
    left = rows.select(*dict.fromkeys([*keys, *outputs]), *floats).repartition(tasks, *keys)
    right = blobs.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(predict, schema)


def registry_output(predictions: DataFrame, spec: PanelSpec) -> DataFrame:
    """The column names a registered model answers with."""
    return predictions.select(
        F.col(spec.grain).alias(f"OUTPUT_{spec.grain}"),
        F.col(spec.time).alias(f"OUTPUT_{spec.time}"),
        F.col("PREDICTION").cast("float").alias(f"PRED_{spec.target}"),
    )


def join_actuals(answers: DataFrame, rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """Registered-model output back under the table's names, with the actual values.

    Rows that share (grain, time) pair up with each other, as in any equi-join.
    """
    named = answers.select(
        F.col(f"OUTPUT_{spec.grain}").alias(spec.grain),
        F.col(f"OUTPUT_{spec.time}").alias(spec.time),
        F.col(f"PRED_{spec.target}").alias("PREDICTION"),
    )
    return named.join(rows.select(*spec.roles), [spec.grain, spec.time]).select(
        *spec.roles, "PREDICTION"
    )


def pair_actuals(answers: DataFrame, rows: DataFrame, spec: PanelSpec, max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """``join_actuals`` one to one: of rows that share (grain, time) the k-th answer meets the k-th actual.

    Answers count in order of their value and actuals in order of the target. Rows without a time
    pair up as well; rows without a series and those that have no partner are left out. Positions
    come from ``rank_in_time``, so neither a hot series nor a hot time is held in one task.
    """
    named = answers.select(
        F.col(f"OUTPUT_{spec.grain}").alias(spec.grain),
        F.col(f"OUTPUT_{spec.time}").alias(spec.time),
        F.col(f"PRED_{spec.target}").alias("PREDICTION"),
    )
    by_answer = PanelSpec(spec.grain, spec.time, "PREDICTION", bucket=spec.bucket)
    by_target = PanelSpec(spec.grain, spec.time, spec.target, bucket=spec.bucket)
    left = _occurrences(named, by_answer, max_task_rows)
    right = _occurrences(rows.select(*spec.roles), by_target, max_task_rows).select(
        *[F.col(c).alias(f"_{c}") for c in (spec.grain, spec.time)], spec.target, F.col("_k").alias("_j")
    )
    same = (
        (F.col(spec.grain) == F.col(f"_{spec.grain}"))
        & F.col(spec.time).eqNullSafe(F.col(f"_{spec.time}"))
        & (F.col("_k") == F.col("_j"))
    )
    return left.join(right, same).select(*spec.roles, "PREDICTION")


def _occurrences(rows: DataFrame, spec: PanelSpec, max_task_rows: int) -> DataFrame:
    """``rows`` with _k, the number of each among those of its (grain, time), from 0."""
    ranked = materialize(rank_in_time(rows, spec, max_task_rows), "occurrences")
    first = ranked.groupBy(F.col(spec.grain).alias("_g"), F.col(spec.time).alias("_t")).agg(F.min("ROW_NUM").alias("_first"))
    same = (F.col(spec.grain) == F.col("_g")) & F.col(spec.time).eqNullSafe(F.col("_t"))
    return ranked.join(first, same).withColumn("_k", F.col("ROW_NUM") - F.col("_first")).drop("_g", "_t", "_first", "ROW_NUM")


def evaluate(predictions: DataFrame, spec: PanelSpec) -> DataFrame:
    """Errors of each series over scored rows.

    ROWS counts those that have a prediction and a target, as MAE and RMSE do; see ``coverage``.
    """
    miss = F.col(spec.target) - F.col("PREDICTION")
    known = F.when(~F.isnan(miss), miss)
    return predictions.groupBy(spec.grain).agg(
        F.avg(F.abs(known)).alias("MAE"),
        F.sqrt(F.avg(known * known)).alias("RMSE"),
        F.count(known).alias("ROWS"),
    )


def coverage(rows: DataFrame, predictions: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows to score and rows scored of each series: TO_SCORE, ANSWERED and, with a number, SCORED."""
    wanted = rows.groupBy(spec.grain).agg(F.count("*").alias("TO_SCORE"))
    number = F.col("PREDICTION").isNotNull() & ~F.isnan("PREDICTION")
    answered = predictions.groupBy(F.col(spec.grain).alias("_series")).agg(
        F.count("*").alias("ANSWERED"), F.count_if(number).alias("SCORED")
    )
    both = wanted.join(answered, F.col(spec.grain).eqNullSafe(F.col("_series")), "left")
    return both.select(spec.grain, "TO_SCORE", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("ANSWERED", "SCORED")])

"""Fits of long series by any learner whose states can be merged.

Every task runs through its rows once and keeps one state per series, so rows are not shuffled and
a series of any length is shared by all tasks that read some of it. The states are merged level by
level, at most FAN_IN in a group, and only one state per series is finished. The errors of the fit
come from scoring its rows with the finished model, part by part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.learners import MergeableLearner
from tidecast.session import materialize, materialize_observed
from tidecast.spec import PanelSpec

FAN_IN = 32  # states merged in one group
HELD_STATES = 1_000  # that a task keeps before it passes them on
BATCH_ROWS = 10_000

METRICS = T.StructType([
    T.StructField("TRAIN_MAE", T.DoubleType()),
    T.StructField("TRAIN_RMSE", T.DoubleType()),
    T.StructField("TRAIN_ROWS", T.LongType()),
    T.StructField("FEATURE_IMPORTANCES", T.MapType(T.StringType(), T.DoubleType())),
])


def fit_schema(df: DataFrame, spec: PanelSpec) -> T.StructType:
    return T.StructType([
        df.schema[spec.grain],
        T.StructField("MODEL_BINARY", T.BinaryType()),
        T.StructField("METRICS", METRICS),
        T.StructField("STATUS", T.StringType()),
        T.StructField("ERROR", T.StringType()),
    ])


def said(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _states(learner: MergeableLearner, features: int, names: list[str], series_type: pa.DataType) -> Callable:
    """One state per series of a task, numbered so that the parts of a series fall into groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[object, np.ndarray] = {}
        errors: dict[object, str] = {}
        part = TaskContext.get().partitionId()

        def emit() -> pa.RecordBatch:
            keys = [*states, *(k for k in errors if k not in states)]
            columns = [
                pa.array(keys, series_type),
                pa.array([part] * len(keys), pa.int64()),
                pa.array([None if k in errors else states[k].tobytes() for k in keys], pa.binary()),
                pa.array([errors.get(k) for k in keys], pa.string()),
            ]
            states.clear()
            errors.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for whole in batches:
            for first in range(0, whole.num_rows, BATCH_ROWS):
                table = pa.Table.from_batches([whole.slice(first, BATCH_ROWS)])
                values = np.column_stack([c.to_numpy() for c in table.columns[1:]]).astype(np.float32)
                coded = table.column(0).combine_chunks().dictionary_encode()
                codes = coded.indices.to_numpy()
                for k, series in enumerate(coded.dictionary.to_pylist()):
                    if series in errors:
                        continue
                    rows = values[codes == k]
                    try:
                        before = states[series] if series in states else learner.start(features)
                        states[series] = learner.add(before, rows[:, 1:], rows[:, 0])
                    except Exception as problem:
                        errors[series] = said(problem)
                if len(states) + len(errors) > HELD_STATES:
                    yield emit()
        if states or errors:
            yield emit()

    return run


def _merge(learner: MergeableLearner) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("_part").to_pylist()
        state, error = None, next((r["_error"] for r in rows if r["_error"] is not None), None)
        if error is None:
            try:
                for r in rows:
                    more = np.frombuffer(r["_state"])
                    state = more if state is None else learner.merge(state, more)
            except Exception as problem:
                error = said(problem)
        made = {"_state": None if error else np.ascontiguousarray(state, dtype=float).tobytes(), "_error": error}
        first = table.slice(0, 1)
        for name, value in (*made.items(), ("_part", rows[0]["_part"] // FAN_IN)):
            at = first.column_names.index(name)
            first = first.set_column(at, name, pa.array([value], first.schema.field(name).type))
        return first

    return run


def _finish(learner: MergeableLearner, features: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, shares, errors = [], [], []
            for state, error in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                blob = found = None
                if error is None:
                    try:
                        blob, found = learner.finish(np.frombuffer(state))
                    except Exception as problem:
                        error = said(problem)
                blobs.append(blob)
                shares.append(None if found is None else [(c, float(v)) for c, v in zip(features, found)])
                errors.append(error)
            columns = [
                batch.column(0),
                pa.array(blobs, pa.binary()),
                pa.array(shares, pa.map_(pa.string(), pa.float64())),
                pa.array(errors, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[batch.schema.names[0], "MODEL_BINARY", "_shares", "ERROR"])

    return run


def merged_states(df: DataFrame, spec: PanelSpec, learner: MergeableLearner) -> DataFrame:
    """grain, _state and _error: one row per series, whatever its length."""
    features = spec.features(df)
    rows = spec.model_input(df).select(spec.grain, spec.target, *features)
    kind = rows.schema[spec.grain].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    names = [spec.grain, "_part", "_state", "_error"]
    schema = T.StructType([
        T.StructField(spec.grain, kind), T.StructField("_part", T.LongType()),
        T.StructField("_state", T.BinaryType()), T.StructField("_error", T.StringType()),
    ])
    found = rows.mapInArrow(_states(learner, len(features), names, to_arrow_type(kind)), schema)
    states, seen = materialize_observed(found, "states", most=F.max("_part"))
    most = seen["most"] or 0
    while True:
        grouped = states.withColumn("_group", F.floor(F.col("_part") / FAN_IN))
        merged = grouped.groupBy(spec.grain, "_group").applyInArrow(_merge(learner), T.StructType([*schema, grouped.schema["_group"]]))
        states = materialize(merged.drop("_group"), "merged-states")
        if most < FAN_IN:
            return states.drop("_part")
        most //= FAN_IN


def fit_merged(df: DataFrame, spec: PanelSpec, learner: MergeableLearner, max_task_rows: int) -> DataFrame:
    """The models of all series of ``df``, as ``fit_schema`` has them; a failing series becomes an error row."""
    from tidecast.operators.scoring import score

    features = spec.features(df)
    kind = df.schema[spec.grain]
    schema = T.StructType([
        kind, T.StructField("MODEL_BINARY", T.BinaryType()), T.StructField("_shares", METRICS["FEATURE_IMPORTANCES"].dataType),
        T.StructField("ERROR", T.StringType()),
    ])
    states = merged_states(df, spec, learner)
    models = materialize(states.mapInArrow(_finish(learner, features), schema), "merged-models")
    named = models.select(
        spec.grain, "MODEL_BINARY", F.lit(learner.name).alias("ALGORITHM"),
        F.array(*[F.lit(c) for c in features]).cast("array<string>").alias("FEATURE_COLS"),
    )
    miss = F.col(spec.target).cast("float").cast("double") - F.col("PREDICTION")
    missed = F.when(~F.isnan(miss), miss)
    errors = score(df, named, spec, "drop", (learner,), max_task_rows).groupBy(F.col(spec.grain).alias("_series")).agg(
        F.avg(F.abs(missed)).alias("TRAIN_MAE"), F.sqrt(F.avg(missed * missed)).alias("TRAIN_RMSE"), F.count("*").alias("TRAIN_ROWS")
    )
    joined = models.join(errors, F.col(spec.grain) == F.col("_series"), "left")
    metrics = F.struct("TRAIN_MAE", "TRAIN_RMSE", "TRAIN_ROWS", F.col("_shares").alias("FEATURE_IMPORTANCES")).cast(METRICS)
    return joined.select(
        spec.grain,
        "MODEL_BINARY",
        F.when(F.col("MODEL_BINARY").isNotNull(), metrics).alias("METRICS"),
        F.when(F.col("MODEL_BINARY").isNotNull(), "ok").otherwise("error").alias("STATUS"),
        "ERROR",
    )

"""Tables that lie by series, so that fitting, scoring and evaluating them shuffles nothing.

A table is stored in a fixed number of buckets by the hash of the series, each sorted by series.
Tables with equal numbers of buckets meet bucket by bucket: the rows of a series and its model are
read by the same task. Series too long for a task take the way in parts, which moves only them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.learners import Boosted, Learner, Linear
from tidecast.operators.scoring import evaluate, score, usable_models
from tidecast.operators.training import fit_one, fit_schema
from tidecast.session import MAX_TASK_ROWS, materialize_observed
from tidecast.spec import PanelSpec


def buckets_for(rows: int, rows_per_bucket: int = MAX_TASK_ROWS) -> int:
    """Buckets of a table of so many rows; tables that are to meet need the same number."""
    return max(1, -(-rows // rows_per_bucket))


def save_by_series(df: DataFrame, table: str, grain: str, buckets: int, path: str | None = None) -> DataFrame:
    """Stores ``df`` in buckets by series, at ``path`` if given, and reads it back; rows without a
    series are left out. Every bucket is one file, written by one task."""
    named = df.filter(F.col(grain).isNotNull()).repartition(buckets, grain)
    writer = named.write.mode("overwrite").format("parquet").bucketBy(buckets, grain).sortBy(grain)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    """Number of buckets of a stored table; an error if it has none."""
    lines = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if not lines.get("Num Buckets", "").isdigit():
        raise ValueError(f"table '{table}' does not lie by series")
    return int(lines["Num Buckets"])


def _long(rows: DataFrame, grain: str, max_task_rows: int) -> tuple[DataFrame, int]:
    """Series of more than ``max_task_rows`` rows; counted where they lie."""
    sizes = rows.groupBy(grain).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > max_task_rows)
    large, seen = materialize_observed(sizes.select(F.col(grain).alias("_series")), "long-here", n=F.count("*"))
    return large, seen["n"] or 0


def fit_here(table: str, spark: SparkSession, spec: PanelSpec, learner: Learner) -> DataFrame:
    """One row per series of a stored table, as ``training.fit_schema`` has it, without a shuffle."""
    rows = spark.table(table)
    bucket_count(spark, table)
    features = spec.features(rows)

    def fit(group: pa.Table) -> pa.Table:
        order = [(spec.time, "ascending"), *[(c, "ascending") for c in [*features, spec.target]]]
        series = group[spec.grain][0].as_py()
        group = group.sort_by(order)
        X = np.column_stack([group[c].to_numpy() for c in features]).astype(np.float32)
        found = fit_one(X, group[spec.target].to_numpy().astype(np.float32), learner, features)
        if found["METRICS"]:
            found["METRICS"]["FEATURE_IMPORTANCES"] = list(found["METRICS"]["FEATURE_IMPORTANCES"].items())
        return pa.Table.from_pylist([{spec.grain: series} | found], schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = fit_schema(rows, spec)
    schema = to_arrow_schema(spark_schema)
    return spec.model_input(rows).groupBy(spec.grain).applyInArrow(fit, spark_schema)


def evaluate_here(
    rows_table: str,
    models_table: str,
    spark: SparkSession,
    spec: PanelSpec,
    learners: tuple[Learner, ...] = (Linear(), Boosted()),
    max_task_rows: int = MAX_TASK_ROWS,
) -> DataFrame:
    """MAE, RMSE and ROWS of every series that has a model: scored and evaluated where they lie.

    Both tables must lie by series in equally many buckets. Long series are scored in parts.
    """
    if bucket_count(spark, rows_table) != bucket_count(spark, models_table):
        raise ValueError("the tables lie in different numbers of buckets")
    rows, models = spark.table(rows_table), usable_models(spark.table(models_table))
    blobs = models.select(spec.grain, "ALGORITHM", "FEATURE_COLS", "MODEL_BINARY")
    by_name = {learner.name: learner for learner in learners}
    large, n = _long(rows, spec.grain, max_task_rows)
    short = rows.join(F.broadcast(large), F.col(spec.grain) == F.col("_series"), "left_anti") if 0 < n <= 10_000 else rows
    if n > 10_000:
        short = rows.join(large, F.col(spec.grain) == F.col("_series"), "left_anti")

    def errors(part: pa.Table, model: pa.Table) -> pa.Table:
        if not part.num_rows or not model.num_rows:
            return pa.Table.from_pylist([], arrow)
        if model.num_rows > 1:
            raise ValueError(f"series {part[spec.grain][0].as_py()} has {model.num_rows} models to choose from")
        stored = model.to_pylist()[0]
        learner = by_name[stored["ALGORITHM"]]
        X = np.column_stack([part[c].to_numpy() for c in stored["FEATURE_COLS"]])
        miss = part[spec.target].to_numpy().astype(float) - learner.predict(learner.load(stored["MODEL_BINARY"]), X)
        miss = miss[~np.isnan(miss)]
        found = {"MAE": float(np.abs(miss).mean()), "RMSE": float(np.sqrt((miss**2).mean()))} if len(miss) else {"MAE": None, "RMSE": None}
        return pa.Table.from_pylist([{spec.grain: part[spec.grain][0].as_py(), "ROWS": len(miss)} | found], arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([
        rows.schema[spec.grain], T.StructField("MAE", T.DoubleType()), T.StructField("RMSE", T.DoubleType()),
        T.StructField("ROWS", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)
    floats = [F.col(c).cast("float").alias(c) for c in spec.features(rows)]
    left = short.select(spec.grain, spec.target, *floats)
    here = left.groupBy(spec.grain).cogroup(blobs.groupBy(spec.grain)).applyInArrow(errors, schema)
    if not n:
        return here
    rest = rows.join(large, F.col(spec.grain) == F.col("_series"), "left_semi")
    return here.unionByName(evaluate(score(rest, models, spec, "drop", learners, max_task_rows), spec))

"""SQL face of training: vectorised table functions over PARTITION BY ... ORDER BY.

``fit_by_table_function`` fits any learner on all features; given to ``fit_models`` it makes a
table of models like any other. It holds one series of bounded size at a time.

``panel_fit`` (``register_panel_fit``) types itself: called on any table, it derives the features,
the partitioning, the order and its output columns from the table and the names of the roles.

``PanelMoments`` keeps running moments of one feature and the target, so its memory does not
grow with its input. Its partial results are merged by an aggregation: a series beyond the
task bound is passed to it in parts and thereby shared by many tasks.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn

from tidecast.operators.learners import Learner
from tidecast.operators.skew import in_parts
from tidecast.operators.training import METRICS, fit_one, fit_schema
from tidecast.session import MAX_TASK_ROWS
from tidecast.spec import PanelSpec

RESULT = (
    "SERIES string, N bigint, FIRST_TS timestamp_ntz, LAST_TS timestamp_ntz, "
    "MEAN_X double, MEAN_Y double, SXX double, SXY double, SYY double"
)


@arrow_udtf(returnType=RESULT)
class PanelMoments:
    """Input columns: series, part, time, x, y."""

    def __init__(self):
        self.series = self.first = self.last = None
        self.n, self.x, self.y = 0, 0.0, 0.0
        self.sxx = self.sxy = self.syy = 0.0

    def eval(self, batch):
        x = batch.column(3).to_numpy(zero_copy_only=False)
        y = batch.column(4).to_numpy(zero_copy_only=False)
        if len(x):
            times = batch.column(2)
            if self.n == 0:
                self.series, self.first = batch.column(0)[0].as_py(), times[0].as_py()
            self.last = times[len(x) - 1].as_py()
            mx, my, n = x.mean(), y.mean(), self.n + len(x)
            dx, dy, weight = mx - self.x, my - self.y, self.n * len(x) / n
            self.sxx += ((x - mx) ** 2).sum() + dx * dx * weight
            self.sxy += ((x - mx) * (y - my)).sum() + dx * dy * weight
            self.syy += ((y - my) ** 2).sum() + dy * dy * weight
            self.x, self.y = self.x + dx * len(x) / n, self.y + dy * len(x) / n
            self.n = n
        return iter(())

    def terminate(self):
        if self.n:
            names = ["SERIES", "N", "FIRST_TS", "LAST_TS", "MEAN_X", "MEAN_Y", "SXX", "SXY", "SYY"]
            values = [self.series, self.n, self.first, self.last]
            values += [self.x, self.y, self.sxx, self.sxy, self.syy]
            yield pa.table({name: [value] for name, value in zip(names, values)})


def register(spark: SparkSession, name: str = "panel_moments") -> None:
    spark.udtf.register(name, PanelMoments)


def train_by_table_function(
    df: DataFrame, spec: PanelSpec, feature: str, max_task_rows: int = MAX_TASK_ROWS
) -> DataFrame:
    """One line per series, fitted by calling the table function from SQL."""
    spark = df.sparkSession
    register(spark)
    columns = [F.col(c).cast("float").cast("double").alias(n) for c, n in ((feature, "x"), (spec.target, "y"))]
    short, spread, _, _ = in_parts(df.filter(F.col(spec.grain).isNotNull()), spec.grain, max_task_rows)
    rows = short.withColumn("_part", F.lit(0))
    if spread is not None:
        rows = rows.unionByName(spread)
    rows = rows.select(
        F.col(spec.grain).cast("string").alias("series"), "_part", F.col(spec.time).alias("ts"), *columns
    )
    parts = spark.sql(
        "SELECT * FROM panel_moments(TABLE({rows}) PARTITION BY (series, _part) ORDER BY ts)",
        rows=rows.filter("x IS NOT NULL AND y IS NOT NULL"),
    )
    total = F.sum("N")
    mean_x, mean_y = F.sum(F.col("N") * F.col("MEAN_X")) / total, F.sum(F.col("N") * F.col("MEAN_Y")) / total

    def about_mean(own: str, a: str, b: str):
        return F.sum(F.col(own) + F.col("N") * F.col(a) * F.col(b))

    merged = parts.groupBy("SERIES").agg(
        total.alias("TRAIN_ROWS"),
        F.min("FIRST_TS").alias("FIRST_TS"),
        F.max("LAST_TS").alias("LAST_TS"),
        mean_x.alias("_x"),
        mean_y.alias("_y"),
        about_mean("SXX", "MEAN_X", "MEAN_X").alias("_xx"),
        about_mean("SXY", "MEAN_X", "MEAN_Y").alias("_xy"),
    )
    sxx = F.col("_xx") - F.col("TRAIN_ROWS") * F.col("_x") * F.col("_x")
    sxy = F.col("_xy") - F.col("TRAIN_ROWS") * F.col("_x") * F.col("_y")
    return merged.withColumn("SLOPE", F.when(sxx > 0, sxy / sxx)).select(
        F.col("SERIES").alias(spec.grain),
        "TRAIN_ROWS",
        "FIRST_TS",
        "LAST_TS",
        "SLOPE",
        (F.col("_y") - F.col("SLOPE") * F.col("_x")).alias("INTERCEPT"),
    )


MODEL = (
    "SERIES string, MODEL_BINARY binary, TRAIN_MAE double, TRAIN_RMSE double, TRAIN_ROWS bigint, "
    "SHARES array<double>, STATUS string, ERROR string"
)
MODEL_ARROW = pa.schema([
    ("SERIES", pa.string()), ("MODEL_BINARY", pa.binary()), ("TRAIN_MAE", pa.float64()), ("TRAIN_RMSE", pa.float64()),
    ("TRAIN_ROWS", pa.int64()), ("SHARES", pa.list_(pa.float64())), ("STATUS", pa.string()), ("ERROR", pa.string()),
])


def trainer(learner: Learner, features: list[str]):
    """Table function with the input columns series, time, target and ``features``."""

    class PanelTrainer:
        def __init__(self):
            self.series, self.held = None, []

        def eval(self, batch):
            if batch.num_rows:
                self.series = batch.column(0)[0].as_py()
                columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 3 + len(features))]
                self.held.append(np.stack(columns, axis=1).astype(np.float32))
            return iter(())

        def terminate(self):
            if self.held:
                rows = np.concatenate(self.held)
                found = fit_one(np.ascontiguousarray(rows[:, 1:]), rows[:, 0].copy(), learner, features)
                metrics = found.pop("METRICS") or {}
                shares = metrics.pop("FEATURE_IMPORTANCES", None)
                made = {"SERIES": self.series, "SHARES": shares and list(shares.values())} | metrics | found
                yield pa.Table.from_pylist([made], MODEL_ARROW)

    return arrow_udtf(PanelTrainer, returnType=MODEL)


def fit_by_table_function(df: DataFrame, spec: PanelSpec, learner: Learner) -> DataFrame:
    """The models of series that fit a task, as ``fit_groups`` makes them, by a call from SQL."""
    spark, features = df.sparkSession, spec.features(df)
    spark.udtf.register("panel_train", trainer(learner, features))
    names = [f"x{k}" for k in range(len(features))]
    rows = spec.model_input(df).select(
        F.col(spec.grain).cast("string").alias("series"), F.col(spec.time).alias("ts"), F.col(spec.target).alias("y"),
        *[F.col(c).alias(n) for c, n in zip(features, names)],
    )
    order = ", ".join(f"{c} ASC NULLS LAST" for c in ["ts", *names, "y"])
    found = spark.sql(f"SELECT * FROM panel_train(TABLE({{rows}}) PARTITION BY series ORDER BY ({order}))", rows=rows)
    shares = F.map_from_arrays(F.array(*[F.lit(c) for c in features]).cast("array<string>"), "SHARES")
    metrics = F.struct("TRAIN_MAE", "TRAIN_RMSE", "TRAIN_ROWS", shares.alias("FEATURE_IMPORTANCES")).cast(METRICS)
    return found.select(
        F.col("SERIES").cast(fit_schema(df, spec)[spec.grain].dataType).alias(spec.grain),
        "MODEL_BINARY",
        F.when(F.col("STATUS") == "ok", metrics).alias("METRICS"),
        "STATUS",
        "ERROR",
    )


NUMBERS = (T.NumericType, T.BooleanType)


def typed_trainer(learner: Learner):
    """Table function of a table and the names of its series, time and target column.

    ``analyze`` runs once per call of the function, on the table's schema alone: every other numeric
    column is a feature, and the result has the series under its own name and type, the model, its
    errors and one IMPORTANCE_ column per feature. A wrong name or a feature that is no number is
    refused before anything runs. Rows of one series are held by one task as float32.
    """

    class PanelFit:
        @staticmethod
        def analyze(rows: AnalyzeArgument, series: AnalyzeArgument, time: AnalyzeArgument, target: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError("the first argument must be TABLE(...)")
            fields = {f.name: f for f in rows.dataType.fields}
            roles = [a.value for a in (series, time, target)]
            for role in roles:
                if role not in fields:
                    raise ValueError(f"no column '{role}'; there are {', '.join(fields)}")
            if len(set(roles)) < 3:
                raise ValueError("series, time and target must be three columns")
            features = [n for n in fields if n not in roles]
            for name in [*features, roles[2]]:
                if not isinstance(fields[name].dataType, NUMBERS):
                    raise ValueError(f"column '{name}' is no number")
            schema = T.StructType([fields[roles[0]]])
            schema.add("TRAIN_ROWS", T.LongType()).add("TRAIN_MAE", T.DoubleType()).add("TRAIN_RMSE", T.DoubleType())
            schema.add("MODEL_BINARY", T.BinaryType()).add("STATUS", T.StringType()).add("ERROR", T.StringType())
            for name in features:
                schema.add(f"IMPORTANCE_{name}", T.DoubleType())
            return AnalyzeResult(
                schema=schema,
                partitionBy=[PartitioningColumn(roles[0])],
                orderBy=[OrderingColumn(c, ascending=True, overrideNullsFirst=False) for c in (roles[1], *features, roles[2])],
                select=[SelectedColumn(c) for c in (*roles, *features)],
            )

        def __init__(self):
            self.series, self.columns = None, None

        def eval(self, row, series, time, target):
            values = tuple(row)
            if self.columns is None:
                self.series, self.features = values[0], list(row.__fields__[3:])
                self.columns = [array("f") for _ in values[2:]]
            for column, value in zip(self.columns, values[2:]):
                column.append(float("nan") if value is None else value)

        def terminate(self):
            if self.columns is None or self.series is None:
                return
            y, *xs = (np.frombuffer(c, np.float32) for c in self.columns)
            X = np.column_stack(xs) if xs else np.empty((len(y), 0), np.float32)
            found = fit_one(X, y.copy(), learner, self.features)
            metrics = found["METRICS"] or {}
            shares = metrics.get("FEATURE_IMPORTANCES") or {}
            yield (
                self.series, *(metrics.get(k) for k in ("TRAIN_ROWS", "TRAIN_MAE", "TRAIN_RMSE")),
                found["MODEL_BINARY"], found["STATUS"], found["ERROR"], *(shares.get(c) for c in self.features),
            )

    return udtf(PanelFit)


def register_panel_fit(spark: SparkSession, learner: Learner, name: str = "panel_fit") -> None:
    """``SELECT * FROM panel_fit(TABLE(t), 'series', 'time', 'target')`` from now on fits this learner."""
    spark.udtf.register(name, typed_trainer(learner))

"""Synthetic feature table as one Spark job: no row is ever made on the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions import calendar, draws
from tidecast.operators.ranking import repeat_rows
from tidecast.spec import PanelSpec


def spine(series: DataFrame, origin: Column, step: str, steps: Column, time: str = "TS") -> DataFrame:
    """Every row of ``series`` repeated for ``steps`` timestamps from ``origin`` on.

    Long spines grow in several tasks, and rows are spread before they multiply.
    """
    calendar.check_timestep(step)
    rows = series.withColumns({"_origin": origin.cast("timestamp_ntz"), "_steps": steps.cast("long")})
    return (
        repeat_rows(rows.filter(F.col("_steps") > 0), "_steps", "_i")
        .withColumn("STEP", (F.col("_i") - 1).cast("int"))
        .withColumn(time, calendar.step_from(F.col("_origin"), step, F.col("STEP")))
        .drop("_origin", "_steps", "_i")
    )


def scaffold(
    ids: DataFrame, spec: PanelSpec, start: dt.date, step: str, steps: int
) -> DataFrame:
    """(grain, time) for every id and timestamp."""
    return spine(ids.select(spec.grain), F.lit(start).cast("timestamp_ntz"), step, F.lit(steps), spec.time)


def feature_table(panel: DataFrame, spec: PanelSpec, num_features: int, seed: str = "42") -> DataFrame:
    """Features and target of a scaffold, in the documented proportions."""
    grain, time = F.col(spec.grain), F.col(spec.time)
    series_key = F.concat(F.lit(seed), F.lit("|"), grain)
    row_key = F.concat(series_key, F.lit("|"), F.col("STEP"))
    name = "FEATURE_{}".format

    def part(key: Column, label: str) -> Column:
        return F.concat(key, F.lit("|"), F.lit(label))

    # The distributions of the generated columns.
    base = panel.withColumns({
        "_base": draws.uniform(part(series_key, "base"), 20.0, 100.0),
        "_effect": draws.uniform(part(series_key, "effect"), 0.7, 1.3),
        "_seasonal": calendar.seasonal(time),
        "_weekday": calendar.weekday_effect(time),
        "_noise": draws.normal(part(row_key, "noise"), 0.0, 3.0),
    })
    special = {
        1: draws.normal(part(row_key, "1"), 50.0, 10.0) * F.col("_effect"),
        2: draws.normal(part(row_key, "2"), 30.0, 5.0) * F.col("_seasonal"),
        3: draws.uniform(part(row_key, "3"), 0.0, 100.0),
        4: calendar.day_of_year_ratio(time),
        5: calendar.weekday_ratio(time),
    }
    values = {
        name(i): F.bround(special.get(i, draws.normal(part(row_key, str(i)), 0.0, 1.0)), 4)
        for i in range(1, num_features + 1)
    }
    target = F.col("_base") * F.col("_effect") * F.col("_seasonal") * F.col("_weekday") + F.col("_noise")
    for i in range(1, num_features + 1):
        target = target + F.lit(0.3 / i) * F.col(name(i))
    return base.withColumns(values).select(
        time,
        grain,
        *values,
        F.greatest(F.lit(0.0), F.bround(target, 2)).alias(spec.target),
    )


def summary(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows, series and date range in one pass."""
    return panel.agg(
        F.count("*").alias("TOTAL_ROWS"),
        F.count_distinct(spec.grain).alias("PARTITIONS"),
        F.min(spec.time).alias("MIN_DATE"),
        F.max(spec.time).alias("MAX_DATE"),
    )

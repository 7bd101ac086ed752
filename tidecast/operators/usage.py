"""Compute use of runs, turned into a cost estimate.

Credits are summed as whole numbers (microseconds x millionths of a credit x nodes), so
totals do not depend on the order of the sum.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions.calendar import micros_between

# Credits per node and hour of each instance family.
INSTANCE_FAMILY_RATES = {
    "CPU_X64_XS": 0.06,
    "CPU_X64_S": 0.19,
    "CPU_X64_M": 0.38,
    "CPU_X64_SL": 0.86,
    "CPU_X64_L": 1.72,
    "HIGHMEM_X64_S": 0.38,
    "HIGHMEM_X64_M": 1.72,
    "HIGHMEM_X64_SL": 5.66,
    "HIGHMEM_X64_L": 7.62,
    "GPU_NV_XS": 1.0,
    "GPU_NV_S": 1.5,
    "GPU_NV_SM": 3.0,
    "GPU_NV_M": 6.0,
    "GPU_NV_2M": 9.0,
    "GPU_NV_3M": 16.0,
    "GPU_NV_L": 18.5,
    "GPU_NV_SL": 32.0,
}

# Credits per hour of each warehouse size.
WAREHOUSE_SIZE_RATES = {
    "X-Small": 1,
    "Small": 2,
    "Medium": 4,
    "Large": 8,
    "X-Large": 16,
    "2X-Large": 32,
    "3X-Large": 64,
    "4X-Large": 128,
    "5X-Large": 256,
    "6X-Large": 512,
}

UNITS_PER_CREDIT = 3600.0 * 1e6 * 1e6


def rate_card(spark: SparkSession, rates: dict[str, float], key: str) -> DataFrame:
    """A price list as a table; a fixed few rows, so it may be broadcast."""
    return spark.createDataFrame(pa.table({key: list(rates), "RATE": [float(v) for v in rates.values()]}))


def priced(df: DataFrame, rates: dict[str, float], key: str) -> DataFrame:
    """``df`` plus RATE; an unknown key costs nothing."""
    card = F.broadcast(rate_card(df.sparkSession, rates, key))
    return df.join(card, key, "left").withColumn("RATE", F.coalesce("RATE", F.lit(0.0)))


def units(micros: Column, rate: Column, nodes: Column) -> Column:
    millionths = F.round(rate * 1_000_000).cast("decimal(12,0)")
    return (micros.cast("decimal(18,0)") * millionths * nodes.cast("decimal(10,0)")).cast("decimal(38,0)")


def half_up(whole: Column, unit: int, digits: int) -> Column:
    """``whole`` counted in ``unit * 10**digits``, rounded half up to ``digits`` places.

    Stays in whole numbers to the end, so that ties round the same way everywhere.
    """
    raised = F.coalesce(whole, F.lit(0)).cast("decimal(38,0)") + F.lit(unit // 2)
    steps = (raised - F.pmod(raised, F.lit(unit))) / F.lit(unit)
    return steps.cast("double") / F.lit(10.0**digits)


def seconds(micros: Column) -> Column:
    return half_up(micros, 10_000, 2)


def minutes(micros: Column) -> Column:
    return half_up(micros, 600_000, 2)


def rounded_credits(unit_sum: Column) -> Column:
    return half_up(unit_sum, 3_600_000_000, 6)


def credits(unit_sum: Column) -> Column:
    return F.coalesce(unit_sum, F.lit(0)).cast("double") / F.lit(UNITS_PER_CREDIT)


def exec_seconds_by_size(query_log: DataFrame, *by: str) -> DataFrame:
    """Execution seconds per warehouse size; queries that used no warehouse do not count."""
    return (
        query_log.filter(F.col("WAREHOUSE_SIZE").isNotNull())
        .groupBy(*by, "WAREHOUSE_SIZE")
        .agg((F.sum("EXECUTION_TIME") / F.lit(1000.0)).alias("TOTAL_EXEC_SECS"))
    )


def tagged(query_log: DataFrame, tag: str) -> DataFrame:
    return query_log.filter(F.col("QUERY_TAG") == tag)


def warehouse_units(query_log: DataFrame, *by: str, rates: dict[str, float] = WAREHOUSE_SIZE_RATES) -> DataFrame:
    """Cost units of a query log per ``by``, with UNITS as a whole number."""
    used = (
        query_log.filter(F.col("WAREHOUSE_SIZE").isNotNull())
        .groupBy(*by, "WAREHOUSE_SIZE")
        .agg((F.sum("EXECUTION_TIME") * 1000).alias("_micros"))
    )
    cost = units(F.col("_micros"), F.col("RATE"), F.lit(1))
    return priced(used, rates, "WAREHOUSE_SIZE").groupBy(*by).agg(F.sum(cost).alias("UNITS"))


def warehouse_credits(query_log: DataFrame, *by: str) -> DataFrame:
    return warehouse_units(query_log, *by).select(*by, credits(F.col("UNITS")).alias("CREDITS"))


def container_runs(run_log: DataFrame, rates: dict[str, float] = INSTANCE_FAMILY_RATES) -> DataFrame:
    """``run_log`` plus MICROS and UNITS; only the container route costs container credits."""
    cost = units(F.col("MICROS"), F.col("RATE"), F.col("NODES"))
    return (
        priced(run_log, rates, "INSTANCE_FAMILY")
        .withColumn("MICROS", micros_between(F.col("STARTED"), F.col("ENDED")))
        .withColumn("UNITS", F.when(F.col("ROUTE") == "container", cost).otherwise(F.lit(0)).cast("decimal(38,0)"))
        .drop("RATE")
    )


def container_credits(run_log: DataFrame) -> DataFrame:
    return container_runs(run_log).withColumn("CREDITS", credits(F.col("UNITS"))).drop("UNITS")


def summary(
    run_log: DataFrame,
    query_log: DataFrame,
    family_rates: dict[str, float] = INSTANCE_FAMILY_RATES,
    size_rates: dict[str, float] = WAREHOUSE_SIZE_RATES,
) -> DataFrame:
    """Cost per job and in total. Both logs carry JOB; warehouse use counts on either route.

    The two logs are summed per job before they meet, and the total comes from the same
    pass as a grouping set.
    """
    runs = container_runs(run_log, family_rates).groupBy("JOB").agg(
        F.sum(F.col("MICROS").cast("decimal(38,0)")).alias("_micros"), F.sum("UNITS").alias("_container")
    )
    used = warehouse_units(query_log, "JOB", rates=size_rates).withColumnRenamed("UNITS", "_warehouse")
    both = runs.join(used, "JOB", "full")
    grouped = both.groupingSets([["JOB"], []], "JOB").agg(
        F.sum("_micros").alias("_micros"),
        F.sum("_container").alias("_container"),
        F.sum("_warehouse").alias("_warehouse"),
    )
    container, warehouse = F.coalesce("_container", F.lit(0)), F.coalesce("_warehouse", F.lit(0))
    return grouped.select(
        F.coalesce("JOB", F.lit("Total")).alias("JOB"),
        seconds(F.col("_micros")).alias("DURATION_SECS"),
        minutes(F.col("_micros")).alias("DURATION_MINS"),
        rounded_credits(container).alias("CONTAINER_CREDITS"),
        rounded_credits(warehouse).alias("WAREHOUSE_CREDITS"),
        rounded_credits(container + warehouse).alias("TOTAL_CREDITS"),
    )


def overview(run_log: DataFrame, query_log: DataFrame) -> DataFrame:
    """``summary`` with the family and node count of each job; '-' on the total row, and where the
    runs of a job differ."""

    def only(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.when(F.min(value).eqNullSafe(F.max(value)), F.max(value)).otherwise("-").alias(c)

    setup = run_log.groupBy("JOB").agg(only("INSTANCE_FAMILY"), only("NODES"))
    named = {c: F.when(F.col("JOB") == "Total", "-").otherwise(F.coalesce(c, F.lit(""))) for c in ("INSTANCE_FAMILY", "NODES")}
    return summary(run_log, query_log).join(setup, "JOB", "left").withColumns(named).select(
        "JOB",
        "INSTANCE_FAMILY",
        "NODES",
        "DURATION_SECS",
        "DURATION_MINS",
        "CONTAINER_CREDITS",
        "WAREHOUSE_CREDITS",
        "TOTAL_CREDITS",
    )

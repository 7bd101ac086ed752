"""Panels and logs over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions import calendar
from tidecast.functions.text import series_id
from tidecast.operators.usage import INSTANCE_FAMILY_RATES, WAREHOUSE_SIZE_RATES
from tidecast.sources.tables import parquet_table
from tidecast.spec import PanelSpec

# events: one row per user and instant. lineitem: one row per supplier and day.
EVENTS = PanelSpec(unique=True, bucket="day")
DAILY = PanelSpec(unique=True, bucket="month")
# lineitem as it is: many rows share a day, the order key settles most of them.
TIED = PanelSpec("l_suppkey", "l_shipdate", "l_extendedprice", ("l_orderkey", "l_linenumber"))

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def cents(column: str) -> Column:
    """Money as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(column) * 100).cast("long")


def events_panel(spark: SparkSession, sf: str) -> DataFrame:
    """User events with the payload number, hour, kind and calendar as features."""
    ts = F.col("ts")
    return parquet_table(spark, sf, "events").select(
        series_id("U", F.col("user_id"), 5).alias("PARTITION_ID"),
        ts.alias("TS"),
        F.from_json("props", "k bigint")["k"].alias("K"),
        F.hour(ts).alias("HOUR"),
        *[(F.col("event_type") == e).cast("int").alias(f"IS_{e.upper()}") for e in EVENT_TYPES],
        calendar.day_of_year_ratio(ts).alias("DOY_RATIO"),
        calendar.weekday_ratio(ts).alias("DOW_RATIO"),
        F.col("value").alias("TARGET"),
    )


def short_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The events panel with two features, for closed-form checks."""
    return events_panel(spark, sf).select("PARTITION_ID", "TS", "K", "HOUR", "TARGET")


def daily_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier sales per ship date."""
    day = F.col("l_shipdate")
    per_day = parquet_table(spark, sf, "lineitem").groupBy("l_suppkey", day).agg(
        F.count("*").alias("n"),
        *[F.sum(cents(c)).alias(c) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice")],
    )
    means = [
        (F.col(c) / F.lit(100.0) / F.col("n")).alias(name)
        for c, name in (("l_quantity", "QUANTITY"), ("l_discount", "DISCOUNT"), ("l_tax", "TAX"))
    ]
    return per_day.select(
        series_id("S", F.col("l_suppkey")).alias("PARTITION_ID"),
        day.alias("TS"),
        *means,
        calendar.day_of_year_ratio(day).alias("DOY_RATIO"),
        calendar.weekday_ratio(day).alias("DOW_RATIO"),
        (F.col("l_extendedprice") / F.lit(100.0)).alias("TARGET"),
    )


def tied_lines(spark: SparkSession, sf: str) -> DataFrame:
    return parquet_table(spark, sf, "lineitem")


def pick(names: list[str], number: Column, spread: int) -> Column:
    """A name by number modulo ``spread``; NULL past the end of the list."""
    return F.get(F.array(*[F.lit(n) for n in names]), F.pmod(number, F.lit(spread)).cast("int"))


def query_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as a query history: some without a warehouse, some of unknown size."""
    sizes = [*WAREHOUSE_SIZE_RATES, "Unlisted"]
    return parquet_table(spark, sf, "events").select(
        F.col("event_type").alias("QUERY_TAG"),
        F.when(F.col("event_type").isin("click", "view"), "Inference").otherwise("Training").alias("JOB"),
        pick(sizes, F.col("user_id"), len(sizes) + 1).alias("WAREHOUSE_SIZE"),
        F.round(F.col("value") * 1000).cast("long").alias("EXECUTION_TIME"),
    )


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as a log of runs, the price being the seconds they took."""
    families = [*INSTANCE_FAMILY_RATES, "UNLISTED"]
    seconds = F.col("o_totalprice").cast("decimal(18,6)")
    nothing = F.lit(0)
    return parquet_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("RUN_ID"),
        F.when(F.col("o_orderstatus") == "F", "Training").otherwise("Inference").alias("JOB"),
        F.when(F.col("o_orderpriority") == "5-LOW", "warehouse").otherwise("container").alias("ROUTE"),
        pick(families, F.col("o_custkey"), len(families)).alias("INSTANCE_FAMILY"),
        (F.pmod(F.col("o_orderkey"), F.lit(5)) + 1).cast("int").alias("NODES"),
        F.col("o_orderdate").alias("STARTED"),
        (F.col("o_orderdate") + F.make_dt_interval(nothing, nothing, nothing, seconds)).alias("ENDED"),
    )


def version_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders read as model versions of customers, one per order."""
    from tidecast.functions.text import model_version, training_run_id

    at = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.pmod("o_orderkey", F.lit(1440)).cast("int"))
    return parquet_table(spark, sf, "orders").select(
        series_id("C", F.col("o_custkey"), 6).alias("PARTITION_ID"), at.alias("TRAINED_AT"), "o_orderpriority"
    ).withColumn("MODEL_VERSION", model_version(F.col("TRAINED_AT"))).withColumn(
        "RUN_ID", training_run_id(F.col("MODEL_VERSION"))
    )

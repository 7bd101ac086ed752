"""Half of all rows in one series, broadcasts off, none of the session's help against skew."""

import pytest
from pyspark.sql import functions as F

from tidecast.operators import ranking, skew, split
from tidecast.operators.linear import coefficients, predict_linear
from tidecast.session import materialize, task_count
from tidecast.spec import PanelSpec

SPEC = PanelSpec(unique=True, bucket="day")
ROWS, BOUND = 60_000, 3_000
PLAIN = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "64",
}


@pytest.fixture
def plain(spark, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in PLAIN}
    for k, v in PLAIN.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(skew, "BROADCAST_SERIES", 0)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(plain):
    series = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 37))
    rows = plain.range(ROWS).select(
        series.alias("PARTITION_ID"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).cast("timestamp_ntz").alias("TS"),
        (F.col("id") % 11).cast("double").alias("X"), F.array(F.col("id")).alias("MORE"), (F.col("id") % 11 * 2.0).alias("TARGET"),
    )
    return materialize(rows, "hot-rows")


def largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_join_deals_out_a_hot_series(plain, hot):
    table = materialize(hot.groupBy("PARTITION_ID").agg(F.count("*").alias("n")), "table")
    joined = skew.join_series(hot, table, "PARTITION_ID", BOUND)
    assert joined.columns == [*hot.columns, "n"] and joined.count() == ROWS
    assert largest_task(joined) < 3 * BOUND
    assert largest_task(hot.join(table, "PARTITION_ID")) >= ROWS // 2  # what the plain join does
    assert joined.groupBy("PARTITION_ID").agg(F.count("*").alias("m"), F.max("n").alias("n")).filter("m <> n").isEmpty()
    some = table.filter("PARTITION_ID < 's2'")
    want = hot.join(some, "PARTITION_ID")
    got = skew.join_series(hot, some, "PARTITION_ID", BOUND)
    assert got.count() == want.count() and got.select("TS", "n").exceptAll(want.select("TS", "n")).isEmpty()


def test_split_and_linear_models_of_a_hot_series(plain, hot, monkeypatch):
    monkeypatch.setattr(skew.join_series, "__defaults__", (BOUND,))
    rows = hot.drop("MORE")
    labelled = split.time_split(rows, SPEC, 0.25)
    assert largest_task(labelled) < 4 * BOUND and labelled.filter("IS_TRAIN").count() == pytest.approx(0.75 * ROWS, abs=40)
    train = materialize(labelled.filter("IS_TRAIN").drop("IS_TRAIN"), "train")
    predictions = predict_linear(rows, coefficients(train, SPEC), SPEC)
    assert largest_task(predictions) < 4 * BOUND
    assert predictions.filter("abs(PREDICTION - TARGET) > 1e-6").isEmpty() and predictions.count() == ROWS


def test_tasks_follow_the_rows(spark):
    assert task_count(spark, 10**12) == 10**6 and task_count(spark, 5) == task_count(spark)
    rows = spark.range(1_000).select((F.col("id") % 3).alias("g"))
    large, most, total = skew.long_series(rows, "g", 100)
    assert (large.count(), most, total) == (3, 4, 1_000)
    assert skew.long_series(rows.limit(0), "g", 100)[1:] == (0, 0)
    assert skew.in_parts(rows, "g", 10_000)[3] == task_count(spark)
    assert ranking.repeat_rows(spark.range(2).withColumn("n", F.lit(3)), "n", "i", 10).count() == 6

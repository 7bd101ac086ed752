import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidecast.functions import calendar, text
from tidecast.operators import generate, usage
from tidecast.plans.jobs import RUN_LOG
from tidecast.session import scratch_path
from tidecast.sources import staging
from tidecast.sources.tables import Namespace, feature_schema, prediction_schema
from tidecast.spec import PanelSpec

SPEC = PanelSpec()


@pytest.fixture
def namespace(spark):
    path = scratch_path(spark, "db")
    made = Namespace(spark, "ns_" + os.path.basename(path).replace("-", "_"), path)
    yield made
    spark.sql("USE default")


def frame(spark):
    rows = [("0001", dt.datetime(2024, 1, 1), 1.5), ("P12345", dt.datetime(2024, 1, 2), 2.5), ("0001", None, 3.5)]
    return spark.createDataFrame(rows, "PARTITION_ID string, TS timestamp_ntz, TARGET double")


def test_namespace_tables(spark, namespace):
    empty = namespace.create("FEATURE_TABLE", feature_schema(SPEC, 5))
    assert empty.columns == ["TS", "PARTITION_ID", *[f"FEATURE_{i}" for i in range(1, 6)], "TARGET"]
    namespace.create("FEATURE_TABLE", feature_schema(SPEC, 2))
    assert len(namespace.table("FEATURE_TABLE").columns) == 8
    namespace.create("PREDICTIONS", prediction_schema(SPEC))
    namespace.save(frame(spark), "T")
    namespace.save(frame(spark), "T", mode="append")
    assert namespace.table("T").count() == 6
    namespace.save(frame(spark), "T")
    assert namespace.table("T").count() == 3
    assert namespace.tables() == ["feature_table", "predictions", "t"]
    assert namespace.exists("T") and not namespace.exists("U")
    namespace.use()
    assert spark.table("T").count() == 3
    kept = namespace.snapshot(namespace.table("T"), "INFER_TRANSIENT")
    namespace.save(frame(spark).limit(1), "T")
    assert kept.count() == 3 and spark.table("INFER_TRANSIENT").count() == 3


def test_export_keeps_ids_and_replaces_the_target(spark):
    path = scratch_path(spark, "export")
    staging.export_by_series(frame(spark).unionByName(frame(spark)), path, "PARTITION_ID")
    staging.export_by_series(frame(spark), path, "PARTITION_ID")
    back = staging.load_by_name(spark, path, frame(spark).schema)
    assert back.exceptAll(frame(spark)).isEmpty() and back.count() == 3
    assert os.path.isdir(os.path.join(path, "SERIES=0001"))


def test_export_writes_a_long_series_from_several_tasks(spark):
    path = scratch_path(spark, "export")
    name = F.when(F.col("id") < 900, "long").when(F.col("id") < 1000, "b")
    df = spark.range(1500).select(name.alias("PARTITION_ID"), F.lit(1).alias("x"))
    staging.export_by_series(df, path, "PARTITION_ID", max_task_rows=200)
    files = [r.NAME for r in staging.list_files(spark, path, "*.parquet").collect()]
    assert sum("SERIES=long" in f for f in files) > 1 and sum("SERIES=b/" in f for f in files) == 1
    assert sum("HIVE_DEFAULT" in f for f in files) > 1
    counts = staging.load_by_name(spark, path, df.schema).groupBy("PARTITION_ID").count()
    assert {r[0]: r[1] for r in counts.collect()} == {"long": 900, "b": 100, None: 500}


def test_export_cuts_files_at_the_size_limit(spark):
    path = scratch_path(spark, "export")
    df = spark.range(1000).select(F.lit("a").alias("PARTITION_ID"), "id")
    staging.export_by_series(df, path, "PARTITION_ID", max_file_bytes=40 * 100)
    files = staging.list_files(spark, path, "*.parquet")
    assert files.count() >= 10
    assert staging.load_by_name(spark, path, df.schema).count() == 1000


def test_export_makes_one_file_per_series_in_folders_named_as_spark_names_them(spark):
    odd = "a b,%2F/x=1:'\"#*?\\{}[]^~\x7f\x01é.|<>&"
    values = [odd, "", None, "..", "long", *map(str, range(40))]
    df = spark.createDataFrame([(v, i, float(k), None if k else b"x") for i, v in enumerate(values) for k in range(3)], "PARTITION_ID string, n int, x double, raw binary")
    df = df.withColumn("at", F.lit(dt.datetime(2024, 1, 1, 1, 2, 3, 4))).withColumn("money", F.lit(1).cast("decimal(20,2)"))
    path, other = scratch_path(spark, "export"), scratch_path(spark, "export")
    for _ in range(2):  # the second replaces the first
        staging.export_by_series(df, path, "PARTITION_ID")
    df.withColumn("SERIES", F.col("PARTITION_ID")).write.partitionBy("SERIES").parquet(other)
    folders = {name for name in os.listdir(path) if "=" in name}
    assert folders == {name for name in os.listdir(other) if "=" in name} and len(folders) == len(values) - 1
    found = [f for _, _, files in os.walk(path) for f in files if "SUCCESS" not in f]
    # One each, and one more if "" and NULL lie in different tasks; no hidden file is left beside them.
    assert len(values) - 1 <= len(found) <= len(values) and not [f for f in found if f.startswith(".")]
    back = staging.load_by_name(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and back.count() == len(values) * 3


def test_export_of_nested_columns(spark):
    df = spark.range(20).select(F.concat(F.lit("s"), F.col("id") % 3).alias("PARTITION_ID"), F.array("id").alias("list"))
    path = scratch_path(spark, "export")
    staging.export_by_series(df, path, "PARTITION_ID")
    back = staging.load_by_name(spark, path, df.schema)
    assert back.exceptAll(df).isEmpty() and back.count() == 20


def test_bulk_load_by_name(spark, namespace):
    path = scratch_path(spark, "load")
    frame(spark).select(
        F.col("TARGET").alias("target"), F.lit(9).alias("extra"), F.col("PARTITION_ID").alias("Partition_Id")
    ).write.parquet(path)
    namespace.create("P", prediction_schema(SPEC))
    staging.load_into(namespace, "P", path)
    staging.load_into(namespace, "P", path)
    rows = namespace.table("P")
    assert rows.count() == 3 and rows.filter("TS IS NULL AND PREDICTION IS NULL").count() == 3
    staging.load_into(namespace, "P", path, truncate_first=False)
    assert namespace.table("P").count() == 6
    assert staging.load_by_name(spark, path, rows.schema, r".*nothing[.]parquet").count() == 0


def spine_of(spark, start, step, n):
    one = spark.createDataFrame([(start,)], "at timestamp_ntz")
    return [r.TS for r in generate.spine(one, F.col("at"), step, F.lit(n)).orderBy("STEP").collect()]


def test_month_spine_clamps_from_its_origin(spark):
    got = spine_of(spark, dt.datetime(2024, 1, 31), "month", 4)
    assert [(t.month, t.day) for t in got] == [(1, 31), (2, 29), (3, 31), (4, 30)]


@pytest.mark.parametrize("step,delta", [
    ("second", dt.timedelta(seconds=1)), ("minute", dt.timedelta(minutes=1)), ("hour", dt.timedelta(hours=1)),
    ("day", dt.timedelta(days=1)), ("week", dt.timedelta(weeks=1)),
])
def test_fixed_steps(spark, step, delta):
    start = dt.datetime(2024, 2, 28)
    assert spine_of(spark, start, step, 5) == [start + i * delta for i in range(5)]


def test_spine_rejects_unknown_steps_and_takes_none(spark):
    assert spine_of(spark, dt.datetime(2024, 1, 1), "day", 0) == []
    with pytest.raises(ValueError, match="cannot step by 'year'"):
        spine_of(spark, dt.datetime(2024, 1, 1), "year", 1)


def test_bucket_grows_with_time(spark):
    rows = [(dt.datetime(1969, 12, 31, 23, 59) + dt.timedelta(minutes=7 * 60 * 24 * i, seconds=i),) for i in range(200)]
    df = spark.createDataFrame(rows + [(None,)], "t timestamp_ntz")
    for unit in ("year", "month", "day", "hour", "minute"):
        got = [r[0] for r in df.orderBy(F.col("t").asc_nulls_last()).select(calendar.time_bucket(F.col("t"), unit)).collect()]
        assert got == sorted(got) and got[-1] == calendar.NO_TIME_BUCKET
    with pytest.raises(ValueError):
        calendar.time_bucket(F.col("t"), "eon")


def test_text_functions(spark):
    df = spark.createDataFrame([("a/b/c/model.pkl", "x\nRUN_ID=training_v1 \ny", "nothing")], "p string, a string, b string")
    row = df.select(
        text.artifact_dir(F.col("p")), text.path_part(F.col("p"), 3), text.run_id_in(F.col("a")),
        text.run_id_in(F.col("b")), text.without_last_name(F.lit("db.schema.stage")),
        text.series_id("P", F.lit(7)), text.series_id("P", F.lit(12345)),
    ).first()
    assert tuple(row) == ("a/b/c", "b", "training_v1", "", "db.schema", "P0007", "P12345")
    at = dt.datetime(2024, 3, 15, 14, 30)
    assert text.version_of(at) == "v20240315_1430"
    assert text.run_ids_of(at) == ("training_v20240315_1430", "inference_20240315_1430")


def test_weekday_and_season(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 2),), (dt.datetime(2024, 3, 4),)], "t timestamp_ntz")
    got = df.select(calendar.weekday_ratio(F.col("t")), calendar.weekday_effect(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(5 / 6, 1.1), (0.0, 1.0)]


def test_elapsed_time_ignores_the_session_time_zone(spark):
    pairs = [
        (dt.datetime(2024, 3, 9, 12), dt.datetime(2024, 3, 10, 12, 0, 0, 250_000)),
        (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1, 23, 59, 58, 500_000)),
    ]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(calendar.seconds_between(F.col("a"), F.col("b"))).collect()]
            assert got == [86400.25, -1.5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_credits(spark):
    t = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [
            ("a", "Training", "container", "CPU_X64_S", 5, t, t + dt.timedelta(seconds=7200, microseconds=500_000)),
            ("b", "Training", "container", "NEW", 5, t, t + dt.timedelta(hours=1)),
            ("c", "Inference", "warehouse", "CPU_X64_S", 5, t, t + dt.timedelta(hours=1)),
        ],
        "RUN_ID string, JOB string, ROUTE string, INSTANCE_FAMILY string, NODES int, STARTED timestamp_ntz, ENDED timestamp_ntz",
    )
    got = {r.RUN_ID: r.CREDITS for r in usage.container_credits(runs).collect()}
    assert got == {"a": pytest.approx(7200.5 / 3600 * 0.19 * 5), "b": 0.0, "c": 0.0}
    log = spark.createDataFrame(
        [("x", "Training", "Medium", 3_600_000), ("x", "Training", "Nano", 5), ("x", "Training", None, 7), ("y", "Inference", "Small", 1800)],
        "QUERY_TAG string, JOB string, WAREHOUSE_SIZE string, EXECUTION_TIME long",
    )
    credits = {r.QUERY_TAG: r.CREDITS for r in usage.warehouse_credits(log, "QUERY_TAG").collect()}
    assert credits == {"x": 4.0, "y": 0.001}
    sizes = {r.WAREHOUSE_SIZE: r.TOTAL_EXEC_SECS for r in usage.exec_seconds_by_size(usage.tagged(log, "x")).collect()}
    assert sizes == {"Medium": 3600.0, "Nano": 0.005}
    rows = {r.JOB: r for r in usage.summary(runs, log).collect()}
    assert rows["Total"].DURATION_SECS == 14400.5 and rows["Total"].DURATION_MINS == 240.01
    assert rows["Training"].TOTAL_CREDITS == pytest.approx(5.900132, abs=1e-6)
    assert rows["Total"].TOTAL_CREDITS == pytest.approx(5.901132, abs=1e-6)


def test_rates_keep_their_digits_and_mixed_setups_show(spark):
    start = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("r1", "Training", "container", "own", n, start, start + dt.timedelta(hours=1)) for n in (1, 2)], RUN_LOG
    )
    log = spark.createDataFrame([], "JOB string, WAREHOUSE_SIZE string, EXECUTION_TIME long")
    row = {r.JOB: r for r in usage.summary(runs, log, {"own": 0.065}).collect()}["Training"]
    assert row.CONTAINER_CREDITS == 0.195
    assert {r.JOB: (r.INSTANCE_FAMILY, r.NODES) for r in usage.overview(runs, log).collect()}["Training"] == ("own", "-")


def test_clock_changes_do_not_disturb_order_or_duration(spark):
    from pyspark.sql import functions as F

    from tidecast.functions.calendar import micros_between, time_bucket

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = F.timestamp_seconds(F.lit(1730608200))  # the clocks go back within the next two hours
        rows = spark.range(16).select(F.timestamp_seconds(F.lit(1730608200) + 600 * F.col("id")).alias("t"), "id")
        got = rows.select("id", time_bucket(F.col("t"), "minute").alias("b"), micros_between(start, F.col("t")).alias("m")).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.b - got[0].b for r in got] == [10 * k for k in range(16)]
    assert [r.m for r in got] == [600_000_000 * k for k in range(16)]

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators import catalog, registry
from tidecast.operators.generate import feature_table, scaffold, summary
from tidecast.operators.learners import Boosted, Linear
from tidecast.operators.scoring import evaluate
from tidecast.operators.table_function import fit_by_table_function, train_by_table_function
from tidecast.operators.training import fit_models
from tidecast.plans.jobs import (
    Workspace, active_models, cost, preview, run_inference, run_training, set_default, test_errors,
)
from tidecast.session import materialize, scratch_path
from tidecast.spec import PanelSpec

SPEC = PanelSpec(unique=True)
AT = dt.datetime(2024, 3, 2, 12, 30)
test_errors.__test__ = False


def generated(spark, series=4, steps=50, features=5):
    ids = spark.range(series).select(F.format_string("P%04d", "id").alias("PARTITION_ID"))
    return feature_table(scaffold(ids, SPEC, dt.date(2024, 3, 2), "day", steps), SPEC, features)


def test_active_version_is_the_newest_per_series(spark):
    rows = [
        ("a", dt.datetime(2024, 1, 1), "v1"),
        ("a", dt.datetime(2024, 1, 2), "v2"),
        ("b", dt.datetime(2024, 1, 1), "v1"),
        ("c", None, "v0"),
        ("c", dt.datetime(2023, 1, 1), "v00"),
    ]
    df = spark.createDataFrame(rows, "PARTITION_ID string, TRAINED_AT timestamp_ntz, MODEL_VERSION string")
    active = {(r[0], r[2]) for r in catalog.with_active(df, SPEC).filter("IS_ACTIVE").collect()}
    # A version without a time sorts first in descending order, so it is the newest.
    assert active == {("a", "v2"), ("b", "v1"), ("c", "v0")}
    timed = df.filter("TRAINED_AT IS NOT NULL")
    assert catalog.latest_version(catalog.with_active(timed, SPEC)).first()[0] == "v2"


def test_artifact_paths_and_loss_check(spark):
    names = ["s/run/train_features/0001/models/model.pkl", "s/run/train_features/0001/models/metrics.parquet"]
    listing = spark.createDataFrame([(n,) for n in names], "NAME string")
    inner = catalog.artifact_paths(listing, "NAME", "model.pkl", "PARTITION_ID", 2)
    assert inner.collect() == [("0001", "s/run/train_features/0001/models")]
    metrics = spark.createDataFrame([("0001", 1), ("0002", 2)], "PARTITION_ID string, N int")
    assert catalog.attach_paths(metrics, inner, SPEC).count() == 1
    assert [r.PARTITION_ID for r in catalog.without_artifact(metrics, inner, SPEC).collect()] == ["0002"]


def test_manifest_splits_into_bounded_maps(spark):
    df = spark.range(500).select(
        F.concat(F.lit("p"), "id").alias("PARTITION_ID"), F.lit("x").alias("STAGE_PATH"), F.lit(True).alias("IS_ACTIVE")
    )
    maps = catalog.manifest(df, SPEC, per_map=50).collect()
    assert sum(len(m.PATHS) for m in maps) == 500 and max(len(m.PATHS) for m in maps) < 120


def test_registry_default_signature_and_conform(spark):
    df = generated(spark)
    rows = registry.entry(df, SPEC, "m", "v1", "r1", AT).unionByName(
        registry.entry(df, SPEC, "m", "v2", "r2", AT + dt.timedelta(hours=1))
    )
    assert registry.resolve(rows, "m")["MODEL_VERSION"] == "v2"
    assert registry.resolve(rows, "m", "v1")["RUN_ID"] == "r1"
    with pytest.raises(ValueError, match="no model 'x'"):
        registry.resolve(rows, "x")
    signature = registry.input_signature(df, SPEC)
    types = {f.name: f.dataType for f in signature}
    assert types["PARTITION_ID"] == T.StringType() and types["TS"] == T.TimestampNTZType()
    assert types["FEATURE_1"] == T.FloatType() and "TARGET" not in types
    assert registry.conform(df, signature).schema["FEATURE_2"].dataType == T.FloatType()
    with pytest.raises(ValueError, match="FEATURE_3"):
        registry.conform(df.drop("FEATURE_3"), signature)
    assert registry.output_signature(SPEC).names == ["OUTPUT_PARTITION_ID", "OUTPUT_TS", "PRED_TARGET"]


def test_generated_table_is_repeatable_and_in_range(spark):
    df = generated(spark, features=7)
    assert df.columns == ["TS", "PARTITION_ID", *[f"FEATURE_{i}" for i in range(1, 8)], "TARGET"]
    again = generated(spark.newSession(), features=7).repartition(13)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, again.collect()))
    row = summary(df, SPEC).first()
    assert tuple(row) == (200, 4, dt.datetime(2024, 3, 2), dt.datetime(2024, 4, 20))
    low, high, least = df.agg(F.min("FEATURE_3"), F.max("FEATURE_3"), F.min("TARGET")).first()
    assert 0 <= low < 10 and 90 < high <= 100 and least >= 0
    mean, sd = df.agg(F.avg("FEATURE_7"), F.stddev("FEATURE_7")).first()
    assert abs(mean) < 0.3 and 0.8 < sd < 1.2


@pytest.mark.parametrize("learner", [Linear(), Boosted(rounds=8)])
def test_training_and_inference_end_to_end(spark, learner):
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    table = generated(spark)
    run_id = run_training(ws, table, SPEC, learner, at=AT)
    assert run_id == "training_v20240302_1230"
    assert spark.table("TRAIN_DATA").count() == 180 and spark.table("TEST_DATA").count() == 20
    assert ws.catalog(SPEC).filter("IS_ACTIVE").count() == 4
    assert ws.table("models", run_id).filter("STATUS = 'ok'").count() == 4

    test = materialize(spark.table("TEST_DATA"), "rows-to-score")
    by_registry = run_inference(ws, test, SPEC, at=AT)
    by_catalog = run_inference(ws, test, SPEC, source="catalog", at=AT + dt.timedelta(minutes=5))
    a, b = ws.table("predictions", by_registry), ws.table("predictions", by_catalog)
    assert a.columns == ["PARTITION_ID", "TS", "TARGET", "PREDICTION"]
    assert a.count() == 20 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert preview(a, SPEC).count() == 5
    naive = test.groupBy("PARTITION_ID").agg(F.stddev("TARGET").alias("s")).agg(F.avg("s")).first()[0]
    assert evaluate(a, SPEC).agg(F.avg("RMSE")).first()[0] < 5 * naive
    assert test_errors(ws, by_registry, SPEC).count() == 4

    # The same run again replaces its own output; a later run becomes the active one.
    run_training(ws, table, SPEC, learner, at=AT)
    later = run_training(ws, table.filter("PARTITION_ID < 'P0002'"), SPEC, learner, at=AT + dt.timedelta(days=1))
    active = {r.PARTITION_ID: r.MODEL_VERSION for r in ws.catalog(SPEC).filter("IS_ACTIVE").collect()}
    assert active["P0000"] == "v20240303_1230" and active["P0003"] == "v20240302_1230"
    run_inference(ws, test, SPEC, source="catalog", at=AT + dt.timedelta(days=1))
    assert spark.table("PREDICTIONS").count() == 20
    with pytest.raises(Exception, match="no model"):
        run_inference(ws, test, SPEC, at=AT + dt.timedelta(days=2))

    log = spark.createDataFrame(
        [(run_id, "Medium", 1800), (later, "Medium", 1800), ("other", "Medium", 9_000_000)],
        "QUERY_TAG string, WAREHOUSE_SIZE string, EXECUTION_TIME long",
    )
    rows = {r.JOB: r for r in cost(ws, log).collect()}
    assert set(rows) == {"Training", "Inference", "Total"}
    assert rows["Training"].WAREHOUSE_CREDITS == 0.004
    assert rows["Training"].INSTANCE_FAMILY == "CPU_X64_S" and rows["Total"].NODES == "-"
    assert rows["Inference"].CONTAINER_CREDITS == 0


@pytest.mark.parametrize("max_task_rows", [1_000_000, 10])
def test_table_function_equals_grouped_regression(spark, max_task_rows):
    df = generated(spark, series=3, steps=90)
    got = {r.PARTITION_ID: r for r in train_by_table_function(df, SPEC, "FEATURE_1", max_task_rows).collect()}
    want = df.groupBy("PARTITION_ID").agg(
        F.regr_slope("TARGET", F.col("FEATURE_1").cast("float").cast("double")).alias("s"),
        F.count("*").alias("n"), F.min("TS").alias("a"), F.max("TS").alias("b"),
    )
    for r in want.collect():
        mine = got[r.PARTITION_ID]
        assert (mine.TRAIN_ROWS, mine.FIRST_TS, mine.LAST_TS) == (r.n, r.a, r.b)
        assert mine.SLOPE == pytest.approx(r.s, rel=1e-4)


@pytest.mark.parametrize("learner", [Boosted(rounds=3, depth=2), Linear()])
@pytest.mark.parametrize("max_task_rows", [1_000, 60])
def test_table_function_fits_any_learner(spark, learner, max_task_rows):
    df = materialize(generated(spark, series=3, steps=90).filter("PARTITION_ID < 'P0002' OR TS < '2024-04-01'"), "rows")
    made, want = (
        fit_models(df, SPEC, learner, "r", "v", AT, max_task_rows, fit_short=f).orderBy("PARTITION_ID").collect()
        for f in (fit_by_table_function, None)
    )
    assert len(made) == 3 and [r.STATUS for r in made] == ["ok"] * 3
    for a, b in zip(made, want):
        assert (a.PARTITION_ID, a.ALGORITHM, a.FEATURE_COLS, a.METRICS.TRAIN_ROWS) == (
            b.PARTITION_ID, b.ALGORITHM, b.FEATURE_COLS, b.METRICS.TRAIN_ROWS
        )
        assert a.METRICS.TRAIN_RMSE == pytest.approx(b.METRICS.TRAIN_RMSE, rel=1e-5)
        assert a.METRICS.FEATURE_IMPORTANCES == pytest.approx(b.METRICS.FEATURE_IMPORTANCES, rel=1e-4, abs=1e-6)
        if isinstance(learner, Boosted):
            assert a.MODEL_BINARY == b.MODEL_BINARY


def test_table_function_reports_errors(spark):
    class Broken(Linear):
        def fit(self, X, y):
            raise ValueError("no")

    rows = generated(spark, series=2)
    models = fit_models(rows, SPEC, Broken(), "r", "v", AT, fit_short=fit_by_table_function).collect()
    assert [(r.STATUS, r.ERROR, r.METRICS, r.MODEL_BINARY) for r in models] == [("error", "ValueError: no", None, None)] * 2
    assert fit_models(rows.limit(0), SPEC, Linear(), "r", "v", AT, fit_short=fit_by_table_function).count() == 0


def test_runs_of_one_minute_keep_apart(spark):
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    table = generated(spark)
    runs = {run_training(ws, table, SPEC, Linear()) for _ in range(2)}
    assert len(runs) == 2
    assert all(ws.table("models", r).count() == 4 for r in runs)


def test_names_defaults_and_failures(spark):
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    table = generated(spark, series=2)
    first = run_training(ws, table, SPEC, Linear(), at=AT, model_name="a")
    second = run_training(ws, table, SPEC, Linear(), at=AT + dt.timedelta(days=1), model_name="a")
    run_training(ws, table, SPEC, Linear(), at=AT + dt.timedelta(days=2), model_name="b")
    assert {r.RUN_ID for r in active_models(ws, SPEC, "a").collect()} == {second}
    assert registry.resolve(ws.table("registry"), "a")["RUN_ID"] == second
    set_default(ws, "a", "v20240302_1230")
    assert registry.resolve(ws.table("registry"), "a")["RUN_ID"] == first
    text_rows = table.withColumn("FEATURE_1", F.col("FEATURE_1").cast("string"))
    run_id = run_inference(ws, text_rows, SPEC, model_name="a", at=AT)
    assert ws.table("predictions", run_id).count() == table.count()
    with pytest.raises(RuntimeError, match="2 of 2 series have no model"):
        run_training(ws, table.withColumn("TARGET", F.lit(None).cast("double")), SPEC, Boosted(rounds=1), at=AT, model_name="c")
    with pytest.raises(ValueError, match="no model 'c'"):
        registry.resolve(ws.table("registry"), "c")
    log = spark.createDataFrame([], "QUERY_TAG string, WAREHOUSE_SIZE string, EXECUTION_TIME long")
    assert {r.JOB for r in cost(ws, log, [first]).collect()} == {"Training", "Total"}

"""Tables that lie by series, kept summaries, and the size of exported files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.test_catalog_and_jobs import generated
from tidecast.operators.generate import summary
from tidecast.operators.learners import Linear, Ridge
from tidecast.operators.scoring import evaluate, score
from tidecast.operators.split import time_split
from tidecast.operators.summaries import PanelStore
from tidecast.operators.training import fit_models
from tidecast.session import materialize, scratch_path
from tidecast.sources import colocated, staging
from tidecast.sources.commits import Conflict
from tidecast.spec import PanelSpec

SPEC = PanelSpec(unique=True)
LOOSE = PanelSpec(bucket="month")
AT = dt.datetime(2024, 3, 2, 12, 30)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, name, df, buckets=3):
    return colocated.save_by_series(df, name, "PARTITION_ID", buckets, scratch_path(spark, name))


@pytest.mark.parametrize("max_task_rows", [1_000_000, 40])
def test_nothing_is_shuffled_between_fit_and_evaluation(spark, max_task_rows):
    rows = materialize(generated(spark, series=5, steps=60).filter("PARTITION_ID <> 'P0003' OR TS < '2024-03-20'"), "rows")
    stored(spark, "rows_here", rows)
    fitted = colocated.fit_here("rows_here", spark, SPEC, Linear())
    assert "Exchange" not in plan(fitted)
    names = [c for c in rows.columns if c.startswith("FEATURE")]
    models = fitted.withColumns({"ALGORITHM": F.lit("linear"), "FEATURE_COLS": F.array(*[F.lit(c) for c in names])})
    stored(spark, "models_here", models)
    found = colocated.evaluate_here("rows_here", "models_here", spark, SPEC, max_task_rows=max_task_rows)
    if max_task_rows == 1_000_000:
        assert "Exchange" not in plan(found) and "CoGroup" in plan(found)
    want = evaluate(score(rows, fit_models(rows, SPEC, Linear(), "r", "v", AT), SPEC), SPEC)
    got = {r.PARTITION_ID: (r.MAE, r.RMSE, r.ROWS) for r in found.collect()}
    for r in want.collect():
        assert got.pop(r.PARTITION_ID) == (pytest.approx(r.MAE, rel=1e-4), pytest.approx(r.RMSE, rel=1e-4), r.ROWS)
    assert not got
    metrics = {r.PARTITION_ID: r.METRICS.TRAIN_ROWS for r in spark.table("models_here").collect()}
    assert metrics["P0000"] == 60 and metrics["P0003"] < 20


def test_tables_that_do_not_meet_are_refused(spark):
    rows = generated(spark, series=2)
    stored(spark, "three_here", rows, 3)
    stored(spark, "two_here", rows, 2)
    with pytest.raises(ValueError, match="different numbers"):
        colocated.evaluate_here("three_here", "two_here", spark, SPEC)
    rows.createOrReplaceTempView("loose_here")
    with pytest.raises(ValueError, match="does not lie by series"):
        colocated.fit_here("loose_here", spark, SPEC, Linear())
    assert colocated.buckets_for(2_500_000) == 3 and colocated.buckets_for(0) == 1


def test_failing_and_missing_models_where_rows_lie(spark):
    rows = generated(spark, series=3)
    stored(spark, "some_rows", rows.withColumn("TARGET", F.when(F.col("PARTITION_ID") != "P0001", F.col("TARGET"))))
    fitted = {r.PARTITION_ID: (r.STATUS, r.ERROR) for r in colocated.fit_here("some_rows", spark, SPEC, Linear()).collect()}
    assert fitted["P0001"] == ("error", "ValueError: no complete row") and fitted["P0000"] == ("ok", None)
    models = fit_models(rows, SPEC, Linear(), "r", "v", AT).filter("PARTITION_ID <> 'P0002'")
    stored(spark, "some_models", models)
    found = {r.PARTITION_ID: (r.MAE is None, r.ROWS) for r in colocated.evaluate_here("some_rows", "some_models", spark, SPEC).collect()}
    assert found == {"P0000": (False, 50), "P0001": (True, 0)}
    stored(spark, "twice_models", models.unionAll(models))
    with pytest.raises(Exception, match="2 models to choose from"):
        colocated.evaluate_here("some_rows", "twice_models", spark, SPEC).collect()


def odd_rows(spark):
    times = [None, AT, AT, AT + dt.timedelta(days=40), dt.datetime(1969, 12, 31, 23, 59, 59)]
    rows = [(s, times[k % 5], float(k % 7)) for k in range(60) for s in ("a", "b", None)] + [("c", AT, 1.0)]
    return spark.createDataFrame(rows, "PARTITION_ID string, TS timestamp_ntz, TARGET double")


@pytest.mark.parametrize("pct", [0.0, 0.1, 0.5, 1.0])
def test_kept_summary_equals_the_full_computation(spark, pct):
    rows = odd_rows(spark)
    store = PanelStore(spark, scratch_path(spark, "panel"), LOOSE, rows.schema)
    assert store.summary().first().TOTAL_ROWS == 0 and store.split(pct).count() == 0
    for k in range(3):
        store.append(rows.filter(F.pmod(F.xxhash64("TARGET"), F.lit(3)) == k))
        if k == 1:
            store.compact()
    named = rows.filter("PARTITION_ID IS NOT NULL")
    assert store.summary().collect() == summary(named, LOOSE).collect()
    want, got = time_split(rows, LOOSE, pct), store.split(pct)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    counts = {r.PARTITION_ID: r.PARTITION_COUNT for r in store.partition_counts().collect()}
    assert counts == {"a": 60, "b": 60, "c": 1}
    store.compact()
    assert store.cells().count() == 9 and store.summary().collect() == summary(named, LOOSE).collect()


def test_an_append_that_dies_adds_nothing_and_compactions_do_not_collide(spark, monkeypatch):
    rows = odd_rows(spark)
    store = PanelStore(spark, scratch_path(spark, "panel"), LOOSE, rows.schema)
    store.append(rows)
    append = store.log.append
    monkeypatch.setattr(store.log, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("dead")))
    with pytest.raises(RuntimeError):
        store.append(rows)
    monkeypatch.setattr(store.log, "append", append)
    assert store.rows().count() == 121
    store.append(rows)
    other = PanelStore(spark, store.root, LOOSE, rows.schema)

    def late(entry, check=lambda earlier: None):
        monkeypatch.setattr(store.log, "append", append)
        other.compact()
        return append(entry, check)

    monkeypatch.setattr(store.log, "append", late)
    with pytest.raises(Conflict):
        store.compact()
    assert store.summary().first().TOTAL_ROWS == 242


def test_only_touched_buckets_are_read_for_the_cutoff(spark):
    rows = generated(spark, series=3, steps=200, features=1)
    store = PanelStore(spark, scratch_path(spark, "panel"), PanelSpec(unique=True, bucket="month"), rows.schema)
    store.append(rows)
    assert len([d for d in os.listdir(next(os.scandir(f"{store.root}/rows")).path) if d.startswith("BUCKET=")]) == 7
    assert "rows/" not in str(store.summary().inputFiles())
    assert store.split(0.1).filter("IS_TRAIN").count() == 3 * 180


def sizes(path):
    return [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_files_stay_below_the_cap(spark):
    text = F.expr("array_join(transform(sequence(1, 160), i -> sha2(concat(id, ':', i), 256)), '')")  # 10 KB that do not compress well
    rows = spark.range(600).select(F.concat(F.lit("s"), F.col("id") % 3).alias("PARTITION_ID"), text.alias("note"), "id")
    path = scratch_path(spark, "export")
    staging.export_by_series(rows, path, "PARTITION_ID", max_file_bytes=200_000)
    assert max(sizes(path)) <= 200_000 and len(sizes(path)) < 120
    assert staging.load_by_name(spark, path, rows.schema).exceptAll(rows).isEmpty()
    # A few wide rows do not cut the narrow ones into small files.
    mixed = rows.withColumn("note", F.when(F.col("id") < 20, F.col("note")))
    staging.export_by_series(mixed.unionByName(spark.range(30_000).select(F.lit("s0").alias("PARTITION_ID"), F.lit("x").alias("note"), "id")), path, "PARTITION_ID", max_file_bytes=200_000)
    assert max(sizes(path)) <= 200_000 and len(sizes(path)) < 30
    assert staging.load_by_name(spark, path, rows.schema).count() == 30_600
    staging.export_by_series(rows.limit(0), path, "PARTITION_ID")
    assert sizes(path) == []


def test_ridge_is_a_learner_like_any_other(spark):
    rows = generated(spark, series=2, features=2)
    a, b = (evaluate(score(rows, fit_models(rows, SPEC, learner, "r", "v", AT), SPEC, "error", (learner,)), SPEC).orderBy("PARTITION_ID").collect() for learner in (Linear(), Ridge()))
    assert [r.RMSE for r in a] == pytest.approx([r.RMSE for r in b], rel=1e-5)

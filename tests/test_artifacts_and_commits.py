"""Artifacts by path, the commit log, loads, event logs, mergeable fits and the typed table function."""

import datetime as dt
import gzip
import json
import os
import subprocess
import sys
import threading
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import tidecast
from tests.conftest import ROOT
from tests.test_catalog_and_jobs import generated
from tidecast.functions.text import path_name
from tidecast.operators import catalog, partial
from tidecast.operators.learners import Linear, Ridge
from tidecast.operators.scoring import coverage, evaluate, pair_actuals, score
from tidecast.operators.table_function import register_panel_fit
from tidecast.operators.training import fit_models
from tidecast.plans import jobs, queries
from tidecast.session import materialize, scratch_path
from tidecast.sources import artifacts, event_log
from tidecast.sources.commits import CommitLog, Conflict
from tidecast.sources.loads import LoadedTable
from tidecast.spec import PanelSpec

cloudpickle.register_pickle_by_value(tidecast)
cloudpickle.register_pickle_by_value(sys.modules[__name__])
SPEC = PanelSpec(unique=True)
AT = dt.datetime(2024, 3, 2, 12, 30)
ODD = ["a/b", "..", ".", "", "x y", "ü*", "p%20", "P0001", "a=b"]


def odd_models(spark, names=ODD):
    rows = generated(spark, series=1, steps=30, features=2)
    rows = rows.drop("PARTITION_ID").join(spark.createDataFrame([(n,) for n in names], "PARTITION_ID string")).select(rows.columns)
    return rows, materialize(fit_models(rows, SPEC, Linear(), "r", "v", AT), "models")


def staged(models, folder):
    entries = materialize(catalog.entries(models, SPEC, "", None, folder), "entries")
    artifacts.write_artifacts(models, entries, folder, "PARTITION_ID")
    return entries


# Artifacts


def test_artifacts_lie_where_the_catalog_says(spark):
    rows, models = odd_models(spark)
    folder = scratch_path(spark, "artifacts")
    entries = staged(models, folder)
    paths = {r.PARTITION_ID: r.STAGE_PATH for r in entries.collect()}
    assert len(set(paths.values())) == len(ODD) and all(os.path.dirname(p) == folder for p in paths.values())
    assert all(len(os.listdir(p)) == 1 for p in paths.values())
    loaded = artifacts.open_artifacts(entries, "PARTITION_ID")
    want = {r.PARTITION_ID: bytes(r.MODEL_BINARY) for r in models.collect()}
    assert {r.PARTITION_ID: bytes(r.MODEL_BINARY) for r in loaded.collect()} == want
    direct, by_path = (evaluate(score(rows, m, SPEC, "error"), SPEC) for m in (models, loaded))
    assert direct.exceptAll(by_path).isEmpty()


def test_reader_opens_only_the_series_asked_for(spark):
    _, models = odd_models(spark)
    folder = scratch_path(spark, "artifacts")
    entries = staged(models, folder)
    paths = {r.PARTITION_ID: r.STAGE_PATH for r in entries.collect()}
    for name in ODD[2:]:  # damaged files are noticed when they are opened
        for f in os.listdir(paths[name]):
            with open(f"{paths[name]}/{f}", "ab") as out:
                out.write(b"x")
    some = artifacts.read_artifacts(spark, folder, ["a/b", "..", "nobody"])
    assert {r.SERIES for r in some.collect()} == {"a/b", ".."} and artifacts.read_artifacts(spark, folder, []).count() == 0
    assert some.filter(F.col("SERIES") == "a/b").count() == 1 and some.count() == 2
    with pytest.raises(Exception, match="damaged"):
        artifacts.read_artifacts(spark, folder).collect()


def test_a_write_that_dies_midway_is_invisible(spark):
    _, models = odd_models(spark, [f"s{k}" for k in range(12)])
    folder = scratch_path(spark, "artifacts")
    entries = materialize(catalog.entries(models, SPEC, "", None, folder), "entries")
    broken = models.withColumn("MODEL_BINARY", F.when(F.col("PARTITION_ID") == "s7", F.lit(None).cast("binary")).otherwise(F.col("MODEL_BINARY")))
    with pytest.raises(Exception):
        artifacts.write_artifacts(broken.repartition(6), entries, folder, "PARTITION_ID")
    assert any(os.path.isdir(f"{folder}/s{k}") for k in range(12))  # some tasks had written
    with pytest.raises(Exception, match="no committed artifacts"):
        artifacts.read_artifacts(spark, folder).collect()
    with pytest.raises(Exception, match="there is no artifact"):
        artifacts.open_artifacts(entries, "PARTITION_ID").collect()
    artifacts.write_artifacts(models, entries, folder, "PARTITION_ID")
    assert artifacts.read_artifacts(spark, folder).count() == 12
    # A later write counts instead of the earlier one; one that dies leaves the earlier one in force.
    artifacts.write_artifacts(models.filter("PARTITION_ID < 's2'"), entries, folder, "PARTITION_ID")
    some = artifacts.read_artifacts(spark, folder).count()
    with pytest.raises(Exception):
        artifacts.write_artifacts(broken, entries, folder, "PARTITION_ID")
    assert some == artifacts.read_artifacts(spark, folder).count() == models.filter("PARTITION_ID < 's2'").count()
    opened = artifacts.open_artifacts(entries, "PARTITION_ID", "drop").filter("MODEL_BINARY IS NOT NULL")
    assert opened.count() == some


def test_artifacts_of_an_empty_run_and_outside_the_folder(spark):
    _, models = odd_models(spark, ["a"])
    folder = scratch_path(spark, "artifacts")
    staged(models.limit(0), folder)
    assert artifacts.read_artifacts(spark, folder).count() == 0
    entries = catalog.entries(models, SPEC, "", None, scratch_path(spark, "elsewhere"))
    with pytest.raises(Exception, match="is not in"):
        artifacts.write_artifacts(models, entries, folder, "PARTITION_ID")


def test_packed_artifacts_are_checked():
    data = artifacts.packed("s", "linear", ["a"], None, b"model")
    assert artifacts.unpacked(data, "x")[1] == b"model"
    for k in range(len(data)):
        with pytest.raises(artifacts.Broken):
            artifacts.unpacked(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :], "x")
    with pytest.raises(artifacts.Broken):
        artifacts.unpacked(b"", "x")


def test_path_names_are_distinct_parts(spark):
    names = [*ODD, "%", "%25", "A.b", "+", "a+b", " "]
    got = [r.p for r in spark.createDataFrame([(n,) for n in names], "n string").select(path_name(F.col("n")).alias("p")).collect()]
    assert len(set(got)) == len(names) and not any("/" in p or p in ("", ".", "..") for p in got)


# Commits


def test_log_keeps_every_entry_of_concurrent_writers(spark):
    folder = scratch_path(spark, "log")
    numbers = []

    def write(k):
        log = CommitLog(spark, folder)
        numbers.extend(log.append({"writer": k, "n": n}) for n in range(4))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    entries = CommitLog(spark, folder).entries()
    assert sorted(numbers) == list(range(16)) and len(entries) == 16
    assert all([e["n"] for e in entries if e["writer"] == k] == [0, 1, 2, 3] for k in range(4))
    assert not [n for n in os.listdir(folder) if n.endswith(".tmp")]


def test_refused_entry_leaves_nothing(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    assert log.entries() == []

    def check(earlier):
        raise Conflict("no")

    with pytest.raises(Conflict):
        log.append({}, check)
    assert log.entries() == [] and log.names() == []


def test_models_of_one_time_keep_apart_and_dead_runs_are_invisible(spark, monkeypatch):
    ws = jobs.Workspace(spark, scratch_path(spark, "workspace"))
    table = generated(spark, series=3)
    first = jobs.run_training(ws, table, SPEC, Linear(), at=AT, model_name="demand")
    second = jobs.run_training(ws, table, SPEC, Linear(), at=AT, model_name="price")
    assert first != second and ws.table("models").count() == 6
    assert {r.MODEL_NAME for r in ws.table("registry").collect()} == {"demand", "price"}

    def die(*_):
        raise RuntimeError("out of luck")

    monkeypatch.setattr(jobs.registry, "entry", die)
    with pytest.raises(RuntimeError, match="out of luck"):
        jobs.run_training(ws, table, SPEC, Linear(), at=AT, model_name="other")
    assert ws.table("models").count() == 6 and ws.table("catalog").count() == 6 and ws.table("run_log").count() == 2
    # Done again under the same id, a run replaces its earlier output only when it succeeds.
    with pytest.raises(RuntimeError, match="out of luck"):
        jobs.run_training(ws, table.filter("PARTITION_ID = 'P0000'"), SPEC, Linear(), at=AT, model_name="price")
    assert ws.table("models", second).count() == 3
    monkeypatch.undo()
    assert jobs.run_training(ws, table.filter("PARTITION_ID = 'P0000'"), SPEC, Linear(), at=AT, model_name="price") == second
    assert ws.table("models", second).count() == 1 and ws.table("run_log").count() == 2
    assert ws.table("split").groupBy("IS_TRAIN").count().count() == 2 and ws.table("split").columns == [*table.columns, "IS_TRAIN"]
    with pytest.raises(ValueError, match="no committed run"):
        ws.table("predictions")


def test_an_id_belongs_to_one_model(spark):
    ws = jobs.Workspace(spark, scratch_path(spark, "workspace"))
    run = ws.run("r", "Training", "a")
    run.save(spark.range(3), "t")
    run.publish()
    with pytest.raises(Conflict, match="model 'a'"):
        ws.run("r", "Training", "b")
    late = jobs.Run.__new__(jobs.Run)
    late.__dict__ |= ws.run("q", "Training", "a").__dict__ | {"run_id": "r", "model_name": "b"}
    with pytest.raises(Conflict):
        late.publish()
    other = ws.run("s", "Training", "a")
    other.save(spark.range(2).withColumn("x", F.lit(1)), "t")
    other.publish()
    assert ws.table("t").columns == ["id", "x"] and ws.table("t").count() == 5


# Loads


def test_ledger_loads_each_file_once(spark):
    path = scratch_path(spark, "staged")
    spark.range(10).repartition(2).write.parquet(f"{path}/a")
    table = LoadedTable(spark, scratch_path(spark, "table"), spark.range(1).schema)
    assert table.rows().count() == 0
    assert table.load(path) == 2 and table.load(path) == 0 and table.rows().count() == 10
    spark.range(10, 13).coalesce(1).write.parquet(f"{path}/b")
    assert table.load(path, ".*/b/.*[.]parquet") == 1 and table.load(path) == 0 and table.rows().count() == 13
    # A changed file is loaded again, as its new rows have not been seen.
    name = next(f for f in os.listdir(f"{path}/b") if f.endswith(".parquet"))
    spark.range(20, 25).coalesce(1).write.parquet(f"{path}/c")
    new = next(f for f in os.listdir(f"{path}/c") if f.endswith(".parquet"))
    os.replace(f"{path}/c/{new}", f"{path}/b/{name}")
    for f in os.listdir(f"{path}/b"):
        if f.endswith(".crc"):
            os.remove(f"{path}/b/{f}")
    assert table.load(path) == 1 and table.rows().count() == 18
    assert table.ledger().count() == 4 and table.load(path, truncate_first=True) == 3 and table.rows().count() == 15
    assert table.load(f"{path}/b", truncate_first=True) == 1 and sorted(r.id for r in table.rows().collect()) == list(range(20, 25))


def test_overtaken_load_starts_again(spark, monkeypatch):
    path = scratch_path(spark, "staged")
    spark.range(6).coalesce(1).write.parquet(path)
    root = scratch_path(spark, "table")
    mine, other = (LoadedTable(spark, root, spark.range(1).schema) for _ in range(2))
    read, calls = LoadedTable._read_in, []

    def slow(self, names, load):
        if not calls:
            calls.append(other.load(path) if calls.append(0) is None else 0)
        return read(self, names, load)

    monkeypatch.setattr(LoadedTable, "_read_in", slow)
    assert mine.load(path) == 0 and mine.rows().count() == 6
    assert mine.log.entries()[0]["loads"] and len(mine.log.entries()) == 1


def test_load_lists_files_in_tasks_and_reads_them_in_portions(spark, monkeypatch):
    path = scratch_path(spark, "staged")
    spark.range(60).withColumn("k", F.col("id") % 12).repartition("k").write.partitionBy("k").parquet(f"{path}/a")
    for name in ("a/_skip/x.parquet", "a/.hidden.parquet", "a/k=1/_no.parquet", "a/k=1/_k=2", "a/k=2/x._COPYING_", "a b/c%2Fd é.txt", "zero"):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "w") as out:
            out.write(name if name != "zero" else "")
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    want = sorted(map(tuple, seen.select("path", "length", "modificationTime").collect()))
    table = LoadedTable(spark, scratch_path(spark, "table"), spark.range(1).schema)
    listed = table.staged(path, ".*")
    assert sorted(map(tuple, listed.collect())) == want and len(want) == 14
    # The driver's plan holds no file of the stage.
    assert not {unquote(urlparse(f).path) for f in listed.inputFiles()} & {w[0].removeprefix("file:") for w in want}
    monkeypatch.setattr("tidecast.sources.loads.FILES_PER_READ", 5)
    read, portions = LoadedTable._read_in, []
    confs = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.manageFilesourcePartitions")
    monkeypatch.setattr(LoadedTable, "_read_in", lambda self, names, load: portions.append(len(names)) or read(self, names, load))
    before = [spark.conf.get(c) for c in confs]
    assert table.load(path) == 12 and table.load(path) == 0 and [spark.conf.get(c) for c in confs] == before
    assert max(portions) <= 5 and sum(portions) == 12
    assert table.rows().count() == 60 and table.rows().distinct().count() == 60 and table.ledger().count() == 12
    assert len(table.loads()) == 1


# Event logs


def event_line(kind, **fields):
    return json.dumps({"Event": f"SparkListener{kind}"} | {k.replace("_", " "): v for k, v in fields.items()}, separators=(",", ":"))


def test_event_log_attributes_tasks_to_the_job_that_ran_them(spark):
    folder = scratch_path(spark, "events")
    mark = "spark-session-01234567-89ab-cdef-0123-456789abcdef"
    tags = f"{mark}-execution-root-id-1,{mark}-thread-01234567-89ab-cdef-0123-456789abcdef-run a,{mark}"
    props = {"spark.job.tags": tags, "spark.sql.execution.id": "1"}
    task = lambda stage, ms: event_line("TaskEnd", Stage_ID=stage, Task_Metrics={"Executor Run Time": ms, "Executor CPU Time": ms * 10**6})
    lines = [
        event_line("ApplicationStart", App_Name="x"),
        event_line("JobStart", Job_ID=0, Submission_Time=1000, Stage_IDs=[0, 1], Properties=props),
        task(0, 5), task(0, 6), task(1, 7),
        event_line("JobEnd", Job_ID=0, Completion_Time=1500, Job_Result={"Result": "JobSucceeded"}),
        event_line("JobStart", Job_ID=1, Submission_Time=1600, Stage_IDs=[1, 2], Properties=props),
        task(2, 100),
        event_line("JobEnd", Job_ID=1, Completion_Time=2100, Job_Result={"Result": "JobFailed"}),
        event_line("JobStart", Job_ID=2, Submission_Time=3000, Stage_IDs=[3], Properties={"spark.job.tags": f"{mark},two,{mark}-three"}),
        task(3, 9), '{"Event":"SparkListenerTaskEnd","Stage ID":3,"Task Met',
    ]
    untagged = [event_line("JobStart", Job_ID=0, Submission_Time=1, Stage_IDs=[0], Properties={}), task(0, 1)]
    os.makedirs(f"{folder}/eventlog_v2_app-2")
    with open(f"{folder}/app-1.inprogress", "w") as out:
        out.write("\n".join(lines))
    with gzip.open(f"{folder}/eventlog_v2_app-2/events_1_app-2.gz", "wt") as out:
        out.write("\n".join(untagged) + "\n")
    with open(f"{folder}/eventlog_v2_app-2/events_2_app-2.zstd", "wb") as out:
        more = [event_line("JobStart", Job_ID=5, Submission_Time=10, Stage_IDs=[0, 9], Properties={"spark.job.tags": "two"}), task(9, 4)]
        with pa.CompressedOutputStream(out, "zstd") as packed:
            packed.write(("\n".join(more) + "\n").encode())
    got = {(r.APP, r.QUERY_ID, r.QUERY_TAG): r for r in event_log.query_log(spark, folder, "Medium").collect()}
    assert set(got) == {("app-1", "1", "run a"), ("app-1", "job-2", "two"), ("app-1", "job-2", "three"), ("app-2", "job-5", "two")}
    one = got["app-1", "1", "run a"]
    assert (one.EXECUTION_TIME, one.TASK_TIME, one.CPU_TIME, one.JOBS, one.FAILED, one.WAREHOUSE_SIZE) == (1100, 118, 118, 2, True, "Medium")
    open_ = got["app-1", "job-2", "two"]
    assert (open_.ENDED, open_.EXECUTION_TIME, open_.TASK_TIME) == (None, 0, 9)
    assert got["app-2", "job-5", "two"].TASK_TIME == 4


def test_event_log_sends_no_list_of_jobs_through_the_driver(spark, sf_small):
    used = queries.usage_of_event_log(spark, sf_small)
    assert len(used.collect()) == 5
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cost_of_a_real_run_needs_no_log_by_hand(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
import datetime as dt
from pyspark.sql import SparkSession
from tests.test_artifacts_and_commits import SPEC, generated
from tidecast.operators.learners import Linear
from tidecast.plans import jobs, queries
from tidecast.sources.event_log import query_log
spark = (SparkSession.builder.master("local[4]").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}")
         .config("spark.sql.shuffle.partitions", "4").config("spark.eventLog.buffer.kb", "1k").getOrCreate())
ws = jobs.Workspace(spark, "{tmp_path}/ws")
run_id = jobs.run_training(ws, generated(spark, series=2), SPEC, Linear(), at=dt.datetime(2024, 3, 2, 12, 30))
spark.range(10).count()
root = spark.sparkContext.applicationId
spark.stop()
spark = SparkSession.builder.master("local[2]").config("spark.eventLog.enabled", "false").getOrCreate()
ws = jobs.Workspace(spark, "{tmp_path}/ws")
import glob
path = [p for p in glob.glob("{tmp_path}/*") if root in p][0]
log = query_log(spark, path, "Medium")
assert [r.QUERY_TAG for r in log.select("QUERY_TAG").distinct().collect()] == [run_id], log.collect()
rows = {{r.JOB: r for r in jobs.cost(ws, log).collect()}}
assert rows["Training"].WAREHOUSE_CREDITS > 0 and log.agg({{"TASK_TIME": "sum"}}).first()[0] > 0
print("fine")
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.strip().endswith("fine"), run.stderr[-3_000:]


# Mergeable fits


def test_merged_states_equal_one_fit():
    rng = np.random.default_rng(0)
    X, y = rng.normal(size=(500, 3)) * [1, 100, 0.01] + [0, 1e4, 3], rng.normal(size=500)
    X[3, 1] = np.nan
    learner = Ridge()
    whole = learner.fit(X, y)
    parts = [learner.add(learner.start(3), X[k : k + 70], y[k : k + 70]) for k in range(0, 500, 70)]
    left, right = learner.start(3), learner.start(3)
    for k, p in enumerate(parts):
        left = learner.merge(left, p)
        right = learner.merge(parts[-1 - k], right)
    for state in (left, right):
        assert np.allclose(learner.load(learner.finish(state)[0]), learner.load(whole[0]), rtol=1e-9)
    assert np.allclose(learner.load(whole[0]), np.frombuffer(Linear().fit(X, y)[0]), rtol=1e-6)
    assert Ridge(1e9).load(Ridge(1e9).fit(X, y)[0])[1:] == pytest.approx(0, abs=1e-6)
    constant = Ridge().fit(np.ones((5, 2)), np.arange(5.0))
    assert Ridge().predict(Ridge().load(constant[0]), np.ones((1, 2))) == pytest.approx(2)


class Tallying:
    """A learner of one's own that notes the largest portion that ``add`` was given."""

    name, own = "ridge", Ridge()

    def fit(self, X, y):
        return self.own.fit(X, y)

    def start(self, features):
        return np.append(self.own.start(features), 0.0)

    def add(self, state, X, y):
        return np.append(self.own.add(state[:-1], X, y), max(state[-1], len(y)))

    def merge(self, a, b):
        return np.append(self.own.merge(a[:-1], b[:-1]), max(a[-1], b[-1]))

    def finish(self, state):
        if state[-1] > 100:
            raise ValueError(f"{int(state[-1])} rows at once")
        return self.own.finish(state[:-1])

    def load(self, blob):
        return self.own.load(blob)

    def predict(self, model, X):
        return self.own.predict(model, X)


@pytest.mark.parametrize("fan_in", [2, 32])
def test_long_series_are_shared_by_tasks(spark, monkeypatch, fan_in):
    monkeypatch.setattr(partial, "FAN_IN", fan_in)
    monkeypatch.setattr(partial, "BATCH_ROWS", 100)
    rows = materialize(generated(spark, series=2, steps=2_000, features=2).filter("PARTITION_ID = 'P0000' OR TS < '2024-04-15'").repartition(9), "rows")
    models = {r.PARTITION_ID: r for r in fit_models(rows, SPEC, Tallying(), "r", "v", AT, max_task_rows=100).collect()}
    want = {r.PARTITION_ID: r for r in fit_models(rows, SPEC, Ridge(), "r", "v", AT).collect()}
    assert {k: r.STATUS for k, r in models.items()} == {"P0000": "ok", "P0001": "ok"}, models
    for k, r in models.items():
        assert np.allclose(np.frombuffer(r.MODEL_BINARY), np.frombuffer(want[k].MODEL_BINARY), rtol=1e-5)
        assert r.METRICS.TRAIN_ROWS == want[k].METRICS.TRAIN_ROWS and r.WARNING is None
        assert r.METRICS.TRAIN_RMSE == pytest.approx(want[k].METRICS.TRAIN_RMSE, rel=1e-5)
    assert models["P0000"].METRICS.TRAIN_ROWS >= 20 * 100


def test_failing_merges_become_error_rows(spark):
    class Failing(Ridge):
        def merge(self, a, b):
            raise ValueError("cannot merge")

    rows = materialize(generated(spark, series=2, steps=300, features=1).repartition(5), "rows")
    models = fit_models(rows, SPEC, Failing(), "r", "v", AT, max_task_rows=100).collect()
    assert [(r.STATUS, r.ERROR, r.MODEL_BINARY) for r in models] == [("error", "ValueError: cannot merge", None)] * 2


# The typed table function


def test_table_function_types_itself(spark):
    register_panel_fit(spark, Linear(), "fit_it")
    rows = generated(spark, series=2, features=3).withColumn("FLAG", F.col("FEATURE_1") > 40)
    rows.withColumnRenamed("PARTITION_ID", "who").createOrReplaceTempView("wide")
    generated(spark, series=2, features=1).withColumn("PARTITION_ID", F.lit(7)).createOrReplaceTempView("narrow")
    wide = spark.sql("SELECT * FROM fit_it(TABLE(wide), 'who', 'TS', 'TARGET')")
    narrow = spark.sql("SELECT * FROM fit_it(TABLE(narrow), 'PARTITION_ID', 'TS', 'TARGET')")
    assert [c for c in wide.columns if c.startswith("IMPORTANCE_")] == [f"IMPORTANCE_{c}" for c in ("FEATURE_1", "FEATURE_2", "FEATURE_3", "FLAG")]
    assert wide.schema["who"].dataType.simpleString() == "string" and narrow.schema["PARTITION_ID"].dataType.simpleString() == "int"
    want = {r.PARTITION_ID: r for r in fit_models(rows, SPEC, Linear(), "r", "v", AT).collect()}
    for r in wide.collect():
        assert r.STATUS == "ok" and r.TRAIN_ROWS == 50 and r.TRAIN_RMSE == pytest.approx(want[r.who].METRICS.TRAIN_RMSE, rel=1e-4)
    assert [r.TRAIN_ROWS for r in narrow.collect()] == [100]


@pytest.mark.parametrize("call, problem", [
    ("fit_it(TABLE(bad), 'nobody', 'TS', 'TARGET')", "no column 'nobody'"),
    ("fit_it(TABLE(bad), 'TS', 'TS', 'TARGET')", "three columns"),
    ("fit_it(TABLE(bad), 'PARTITION_ID', 'TS', 'TARGET')", "column 'NOTE' is no number"),
])
def test_table_function_refuses_before_it_runs(spark, call, problem):
    register_panel_fit(spark, Linear(), "fit_it")
    generated(spark, series=1).withColumn("NOTE", F.lit("x")).createOrReplaceTempView("bad")
    with pytest.raises(Exception, match=problem):
        spark.sql(f"SELECT * FROM {call}")


# Pairing and coverage


@pytest.mark.parametrize("max_task_rows", [1_000_000, 10])
def test_pairs_are_one_to_one(spark, max_task_rows):
    rows = [("a", None, float(k % 3)) for k in range(40)] + [("a", AT, float(k)) for k in range(30)] + [("b", AT, 1.0), (None, AT, 2.0)]
    table = spark.createDataFrame(rows, "PARTITION_ID string, TS timestamp_ntz, TARGET double")
    answers = table.select(F.col("PARTITION_ID").alias("OUTPUT_PARTITION_ID"), F.col("TS").alias("OUTPUT_TS"), (F.col("TARGET") * 2).alias("PRED_TARGET"))
    got = pair_actuals(answers, table, SPEC, max_task_rows).collect()
    assert len(got) == 71 and all(r.PREDICTION == 2 * r.TARGET for r in got)
    fewer = pair_actuals(answers.filter("PRED_TARGET < 40 OR OUTPUT_TS IS NULL"), table, SPEC, max_task_rows)
    assert fewer.count() == 61


def test_evaluate_counts_scored_rows_only(spark):
    rows = [("a", AT, 1.0, 2.0), ("a", AT, 1.0, None), ("a", AT, 1.0, float("nan")), ("b", AT, None, 1.0), ("c", AT, 4.0, 4.0)]
    table = spark.createDataFrame(rows, "PARTITION_ID string, TS timestamp_ntz, TARGET double, PREDICTION double")
    got = {r.PARTITION_ID: (r.MAE, r.RMSE, r.ROWS) for r in evaluate(table, SPEC).collect()}
    assert got == {"a": (1.0, 1.0, 1), "b": (None, None, 0), "c": (0.0, 0.0, 1)}
    to_score = spark.createDataFrame([("a", AT), ("a", AT), ("z", AT)], "PARTITION_ID string, TS timestamp_ntz")
    assert {tuple(r) for r in coverage(to_score, table, SPEC).collect()} == {("a", 2, 3, 1), ("z", 1, 0, 0)}

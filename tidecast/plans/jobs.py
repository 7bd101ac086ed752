"""The two jobs, training and inference, over a folder of tables.

A run writes every table into a folder of its own and publishes them all by one entry of the
workspace's commit log. Until then nobody sees any of them, so a run that dies between its tables
leaves no trace in what readers get, and of concurrent runs none is lost. A run that is done again
under the same id replaces its earlier output at once.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.text import run_ids_of, version_of
from tidecast.operators import catalog, registry, usage
from tidecast.operators.learners import Boosted, Learner, Linear
from tidecast.operators.scoring import evaluate, score
from tidecast.operators.split import time_split
from tidecast.operators.training import fit_models
from tidecast.session import materialize
from tidecast.sources.artifacts import open_artifacts, write_artifacts
from tidecast.sources.commits import CommitLog, Conflict
from tidecast.spec import PanelSpec

MODEL_NAME = "PANEL_MODEL"
SMOKE_SERIES, SMOKE_ROWS = 3, 30
RUN_LOG = (
    "RUN_ID string, JOB string, ROUTE string, INSTANCE_FAMILY string, NODES int, "
    "STARTED timestamp_ntz, ENDED timestamp_ntz"
)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def unique_end(at: dt.datetime | None) -> str:
    """What tells runs of one minute apart; nothing for a run whose time is given."""
    return "" if at else f"_{uuid.uuid4().hex[:8]}"


def schema_from(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


class Workspace:
    """Tables of a project: ``split``, ``models``, ``catalog``, ``registry``, ``predictions``, ``run_log``.

    Reads see the runs that are committed when the read begins.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")

    def run(self, run_id: str, job: str, model_name: str = "") -> Run:
        return Run(self, run_id, job, model_name)

    def committed(self) -> dict[str, dict]:
        """The last commit of every run, in the order of the runs' first commits."""
        found: dict[str, dict] = {}
        for entry in self.log.entries():
            found[entry["run_id"]] = entry
        return found

    def table(self, table: str, run_id: str | None = None) -> DataFrame:
        """One run of a table, or all of them; columns that some runs lack are null there."""
        runs = self.committed()
        wanted = runs.values() if run_id is None else [runs[run_id]] if run_id in runs else []
        paths: dict[str, list[str]] = {}
        for entry in wanted:
            if table in entry["tables"]:
                path, schema = entry["tables"][table]
                paths.setdefault(schema, []).append(f"{self.root}/{path}")
        if not paths:
            raise ValueError(f"no committed run{'' if run_id is None else f' {run_id!r}'} has a table '{table}'")
        folders = [T.StructField(c, T.StringType()) for c in ("RUN", "ATTEMPT")]
        read = self.spark.read.option("basePath", f"{self.root}/{table}")
        parts = [read.schema(T.StructType([*schema_from(s), *folders])).parquet(*p).drop("RUN", "ATTEMPT") for s, p in paths.items()]
        return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def catalog(self, spec: PanelSpec) -> DataFrame:
        return catalog.with_active(self.table("catalog"), spec)


class Run:
    """What one run writes, none of which counts before ``commit``."""

    def __init__(self, ws: Workspace, run_id: str, job: str, model_name: str):
        self.ws, self.run_id, self.job, self.model_name = ws, run_id, job, model_name
        self.attempt = uuid.uuid4().hex
        self.tables: dict[str, tuple[str, str]] = {}  # path and schema
        self.refuse(ws.log.entries())

    def refuse(self, earlier: list[dict]) -> None:
        """Another job or model may have taken the id."""
        for entry in earlier:
            if entry["run_id"] == self.run_id and (entry["job"], entry["model_name"]) != (self.job, self.model_name):
                raise Conflict(f"run '{self.run_id}' is one of {entry['job']} of model '{entry['model_name']}'")

    def folder(self, table: str) -> str:
        return f"{self.ws.root}/{table}/RUN={self.run_id}/ATTEMPT={self.attempt}"

    def save(self, df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Writes a table of the run and reads it back."""
        df.write.partitionBy(*partition_by).parquet(self.folder(table))
        self.tables[table] = (self.folder(table).removeprefix(f"{self.ws.root}/"), df.schema.json())
        return self.ws.spark.read.schema(df.schema).parquet(self.folder(table))

    def commit(self, route: str, family: str, nodes: int, started: dt.datetime) -> str:
        """Logs the run and publishes all its tables."""
        row = (self.run_id, self.job, route, family, nodes, started, utc_now())
        self.save(self.ws.spark.createDataFrame([row], RUN_LOG), "run_log")
        self.publish()
        return self.run_id

    def publish(self) -> None:
        entry = {"run_id": self.run_id, "job": self.job, "model_name": self.model_name, "tables": self.tables}
        self.ws.log.append(entry, self.refuse)


def run_ids(at: dt.datetime, model_name: str) -> tuple[str, str]:
    """Ids of a training and an inference run: of the default model by time alone, of others with their name."""
    named = "" if model_name == MODEL_NAME else "_" + quote(model_name, safe="")
    return tuple(run_id + named for run_id in run_ids_of(at))


def run_training(
    ws: Workspace,
    features: DataFrame,
    spec: PanelSpec,
    learner: Learner = Boosted(),
    test_pct: float = 0.1,
    at: dt.datetime | None = None,
    model_name: str = MODEL_NAME,
    route: str = "container",
    family: str = "CPU_X64_S",
    nodes: int = 5,
    max_failed: float = 0.5,
) -> str:
    """Split, fit, store artifacts, catalogue and register; returns the run id.

    Nothing is published if more than the share ``max_failed`` of the series get no model, or if
    the models do not score their own rows.
    """
    started = utc_now()
    end, at = unique_end(at), at or started
    version, run_id = version_of(at), run_ids(at, model_name)[0] + end
    spark = ws.spark
    run = ws.run(run_id, "Training", model_name)
    spark.addTag(run_id)
    try:
        labelled = run.save(time_split(features, spec, test_pct), "split", ("IS_TRAIN",))
        train = labelled.filter(F.col("IS_TRAIN")).drop("IS_TRAIN")
        train.createOrReplaceTempView("TRAIN_DATA")
        labelled.filter(~F.col("IS_TRAIN")).drop("IS_TRAIN").createOrReplaceTempView("TEST_DATA")
        models = run.save(fit_models(train, spec, learner, run_id, version, at), "models")
        check_models(train, models, spec, learner, max_failed)
        stage = run.folder("artifacts")
        entries = run.save(catalog.entries(models, spec, stage, model_name, stage), "catalog")
        write_artifacts(models, entries, stage, spec.grain)
        run.save(registry.entry(train, spec, model_name, version, run_id, at), "registry")
    finally:
        spark.removeTag(run_id)
    return run.commit(route, family, nodes, started)


def check_models(train: DataFrame, models: DataFrame, spec: PanelSpec, learner: Learner, max_failed: float) -> None:
    """Raises if too many series failed, or if some rows cannot be scored by the stored models."""
    fitted = F.count_if(F.col("MODEL_BINARY").isNotNull())
    counts = models.agg(F.count("*").alias("series"), fitted.alias("fitted")).first()
    failed = counts["series"] - counts["fitted"]
    if failed > max_failed * counts["series"]:
        raise RuntimeError(f"{failed} of {counts['series']} series have no model")
    few = models.filter(F.col("MODEL_BINARY").isNotNull()).limit(SMOKE_SERIES)
    few = materialize(few, "smoke-models")
    rows = materialize(train.join(few, spec.grain, "left_semi").limit(SMOKE_ROWS), "smoke-rows")
    if score(rows, few, spec, "error", (learner,)).count() != rows.count():
        raise RuntimeError("the stored models do not score every row of their series")


def set_default(ws: Workspace, model_name: str, version: str) -> None:
    """Makes a registered version the default by registering it once more."""
    entries = ws.table("registry").filter((F.col("MODEL_NAME") == model_name) & (F.col("MODEL_VERSION") == version))
    last = entries.orderBy(F.col("CREATED_AT").desc(), F.col("RUN_ID").desc()).first()
    if last is None:
        raise ValueError(f"no model '{model_name}' in version '{version}'")
    newest = ws.table("registry").filter(F.col("MODEL_NAME") == model_name).agg(F.max("CREATED_AT")).first()[0]
    row = {**last.asDict(), "CREATED_AT": max(utc_now(), newest + dt.timedelta(microseconds=1))}
    again = ws.spark.createDataFrame([tuple(row[c] for c in entries.columns)], entries.schema)
    run = ws.run(f"default_{uuid.uuid4().hex}", "Default", model_name)
    run.save(again, "registry")
    run.publish()


def active_models(ws: Workspace, spec: PanelSpec, model_name: str = MODEL_NAME, on_missing: str = "error") -> DataFrame:
    """The model each series currently uses, from whichever run it came, loaded from its STAGE_PATH."""
    active = ws.catalog(spec).filter(F.col("IS_ACTIVE") & (F.col("MODEL_NAME") == model_name))
    return open_artifacts(active, spec.grain, on_missing, ("RUN_ID",))


def run_inference(
    ws: Workspace,
    rows: DataFrame,
    spec: PanelSpec,
    source: str = "registry",
    model_name: str = MODEL_NAME,
    version: str | None = None,
    learners: tuple[Learner, ...] = (Linear(), Boosted()),
    at: dt.datetime | None = None,
    route: str = "warehouse",
    family: str = "",
    nodes: int = 0,
) -> str:
    """Score ``rows`` and publish the predictions; returns the run id.

    With ``source='registry'`` the rows must match the signature of the registered version
    and a series without a model is an error. With ``source='catalog'`` each series uses its
    active model, loaded from its path, and a series without one is left out.
    """
    started = utc_now()
    run_id = run_ids(at or started, model_name)[1] + unique_end(at)
    run = ws.run(run_id, "Inference", model_name)
    ws.spark.addTag(run_id)
    try:
        if source == "registry":
            chosen = registry.resolve(ws.table("registry"), model_name, version)
            signature = schema_from(chosen["SIGNATURE"])
            rows = registry.conform(rows, signature, *[c for c in rows.columns if c == spec.target])
            models, policy = ws.table("models", chosen["RUN_ID"]), "error"
            models = models.withColumn(spec.grain, F.col(spec.grain).cast(rows.schema[spec.grain].dataType))
        elif source == "catalog":
            models, policy = materialize(active_models(ws, spec, model_name), "active-models"), "drop"
        else:
            raise ValueError("source must be 'registry' or 'catalog'")
        predictions = run.save(score(rows, models, spec, policy, learners), "predictions")
        predictions.createOrReplaceTempView("PREDICTIONS")
    finally:
        ws.spark.removeTag(run_id)
    return run.commit(route, family, nodes, started)


def preview(predictions: DataFrame, spec: PanelSpec, n: int = 5) -> DataFrame:
    """The first rows in series and time order."""
    return predictions.orderBy(spec.grain, spec.time).limit(n)


def test_errors(ws: Workspace, run_id: str, spec: PanelSpec) -> DataFrame:
    return evaluate(ws.table("predictions", run_id), spec)


def cost(ws: Workspace, query_log: DataFrame, run_ids: list[str] | None = None) -> DataFrame:
    """Cost estimate of the runs named, or of all logged ones. ``query_log`` holds QUERY_TAG, WAREHOUSE_SIZE and
    EXECUTION_TIME in milliseconds; a query belongs to the run whose id is its tag. Runs tag their own work, so
    ``sources.event_log.query_log`` makes such a log from what Spark has recorded."""
    runs = ws.table("run_log")
    if run_ids is not None:
        runs = runs.filter(F.col("RUN_ID").isin(run_ids))
    jobs = runs.select(F.col("RUN_ID").alias("QUERY_TAG"), "JOB")
    return usage.overview(runs, query_log.join(jobs, "QUERY_TAG"))

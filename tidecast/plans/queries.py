"""Registered queries: name -> function of (session, folder of the tables)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions import calendar, text
from tidecast.operators import catalog, generate, registry, usage
from tidecast.operators.learners import Boosted, Linear, Ridge
from tidecast.operators.linear import coefficients, predict_linear
from tidecast.operators.ranking import rank_in_time
from tidecast.operators.scoring import (
    coverage,
    evaluate,
    join_actuals,
    missing_model_rows,
    pair_actuals,
    registry_output,
    score,
)
from tidecast.operators.summaries import PanelStore
from tidecast.operators.split import label_rows, partition_counts, split_points, time_split, train_test
from tidecast.operators.table_function import fit_by_table_function, register_panel_fit, train_by_table_function
from tidecast.operators.training import fit_models, metrics_long
from tidecast.plans import panels
from tidecast.plans.jobs import Workspace, preview, run_inference, run_training
from tidecast.plans.panels import DAILY, EVENTS, TIED
from tidecast.session import materialize, scratch_path
from tidecast.sources import artifacts, colocated, event_log, staging
from tidecast.sources.loads import LoadedTable
from tidecast.sources.tables import parquet_table
from tidecast.spec import PanelSpec

TEST_PCT = 0.1
RUN_AT = dt.datetime(2024, 3, 2, 12, 30)
VERSION = text.version_of(RUN_AT)
RUN_ID = text.run_ids_of(RUN_AT)[0]
ROOT = "models"
MIN_TRAIN_ROWS = 60
BY_FLAG = PanelSpec("PARTITION_ID", "TS", "TARGET")
STUMP = Boosted(rounds=1, depth=1)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Panels


def panel_build_daily(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(panels.daily_panel(spark, sf), 6, "QUANTITY", "DISCOUNT", "TAX", "DOY_RATIO", "DOW_RATIO")


def panel_features_events(spark, sf):
    return rounded(panels.events_panel(spark, sf), 6, "DOY_RATIO", "DOW_RATIO")


def panel_model_input(spark, sf):
    typed = EVENTS.model_input(panels.events_panel(spark, sf))
    return typed.select(
        "PARTITION_ID", "TS", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in typed.columns[2:]]
    )


def panel_summary(spark, sf):
    return generate.summary(panels.tied_lines(spark, sf), TIED)


def rows_per_partition(spark, sf):
    return partition_counts(panels.tied_lines(spark, sf), TIED)


# Ranks and splits


def rank_in_time_events(spark, sf):
    return rank_in_time(panels.short_panel(spark, sf), EVENTS).select("PARTITION_ID", "TS", "ROW_NUM")


def rank_in_time_ties(spark, sf):
    return rank_in_time(panels.tied_lines(spark, sf), TIED)


def labelled_events(spark, sf):
    return time_split(panels.short_panel(spark, sf), EVENTS, TEST_PCT)


def split_train(spark, sf):
    return train_test(labelled_events(spark, sf))[0]


def split_test(spark, sf):
    return train_test(labelled_events(spark, sf))[1]


def split_ties(spark, sf):
    return time_split(panels.tied_lines(spark, sf), TIED, TEST_PCT)


def split_cutoffs(spark, sf):
    """Count and cutoff of each series for several test shares."""
    df = panels.tied_lines(spark, sf).select("l_suppkey", "l_shipdate")
    counts = partition_counts(df, TIED).withColumn(
        "TEST_PCT", F.explode(F.array(*[F.lit(p) for p in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)]))
    )
    cutoff = F.floor(F.col("PARTITION_COUNT") * (F.lit(1.0) - F.col("TEST_PCT"))).cast("long")
    return counts.withColumn("TRAIN_CUTOFF", cutoff)


def split_counts(spark, sf):
    return labelled_events(spark, sf).groupBy("IS_TRAIN").agg(F.count("*").alias("ROWS"))


def split_boundaries(spark, sf):
    """Last training and first test instant of each series."""
    labelled = labelled_events(spark, sf)
    return labelled.groupBy("PARTITION_ID").agg(
        F.max(F.when(F.col("IS_TRAIN"), F.col("TS"))).alias("LAST_TRAIN"),
        F.min(F.when(~F.col("IS_TRAIN"), F.col("TS"))).alias("FIRST_TEST"),
        F.count_if("IS_TRAIN").alias("TRAIN_ROWS"),
        F.count_if(~F.col("IS_TRAIN")).alias("TEST_ROWS"),
    )


def split_daily(spark, sf):
    panel = materialize(panels.daily_panel(spark, sf), "features")
    return time_split(panel.select("PARTITION_ID", "TS", "TARGET"), DAILY, 0.25)


def split_roundtrip(spark, sf):
    """Rows lost and rows gained by splitting and joining again."""
    df = panels.short_panel(spark, sf)
    train, test = train_test(labelled_events(spark, sf))
    both = train.unionByName(test)
    lost = df.exceptAll(both).select(F.lit("lost").alias("SIDE"))
    gained = both.exceptAll(df).select(F.lit("gained").alias("SIDE"))
    return lost.unionByName(gained).agg(
        F.count_if(F.col("SIDE") == "lost").alias("LOST"), F.count_if(F.col("SIDE") == "gained").alias("GAINED")
    )


def growing_panel(spark, sf):
    """The events panel, stored in three appends, the first two of them compacted."""
    panel = panels.short_panel(spark, sf)
    store = PanelStore(spark, scratch_path(spark, "panel"), EVENTS, panel.schema)
    hour = F.hour("TS")
    store.append(panel.filter(hour < 8))
    store.append(panel.filter((hour >= 8) & (hour < 20)))
    store.compact()
    store.append(panel.filter(hour >= 20))
    return store


def summary_appended(spark, sf):
    return growing_panel(spark, sf).summary()


def split_appended(spark, sf):
    return growing_panel(spark, sf).split(TEST_PCT)


# Linear models as relations


def linreg_sides(spark, sf):
    df = panels.short_panel(spark, sf)
    points = split_points(df, EVENTS, TEST_PCT)
    train, test = train_test(label_rows(df, points, EVENTS))
    return coefficients(train, EVENTS), test


def linreg_fit(spark, sf):
    coef, _ = linreg_sides(spark, sf)
    names = ("INTERCEPT", "COEF_K", "COEF_HOUR")
    return coef.select("PARTITION_ID", *[F.round(F.col("_coef")[i], 6).alias(n) for i, n in enumerate(names)])


def linreg_predict(spark, sf):
    coef, test = linreg_sides(spark, sf)
    return rounded(predict_linear(test, coef, EVENTS), 5, "PREDICTION")


def linreg_eval(spark, sf):
    coef, test = linreg_sides(spark, sf)
    return rounded(evaluate(predict_linear(test, coef, EVENTS), EVENTS), 5, "MAE", "RMSE")


# Training


def event_sides(spark, sf):
    return train_test(labelled_events(spark, sf))


def linear_models(train):
    return fit_models(train, EVENTS, Linear(), RUN_ID, VERSION, RUN_AT)


def flat_metrics(models: DataFrame) -> DataFrame:
    return models.select(
        "PARTITION_ID",
        "RUN_ID",
        "MODEL_VERSION",
        "ALGORITHM",
        "TRAINED_AT",
        "STATUS",
        F.col("METRICS.TRAIN_ROWS").alias("TRAIN_ROWS"),
        F.round("METRICS.TRAIN_MAE", 5).alias("TRAIN_MAE"),
        F.round("METRICS.TRAIN_RMSE", 5).alias("TRAIN_RMSE"),
    )


def train_models_linear(spark, sf):
    return flat_metrics(linear_models(split_train(spark, sf)))


def metrics_by_feature(spark, sf):
    return rounded(metrics_long(linear_models(split_train(spark, sf)), EVENTS), 5, "IMPORTANCE")


def metrics_variant(spark, sf):
    """Metrics as a semi-structured value and read back by path."""
    value = F.to_variant_object("METRICS").alias("METRICS")
    models = linear_models(split_train(spark, sf))
    stored = materialize(models.select("PARTITION_ID", value), "staging")
    return stored.select(
        "PARTITION_ID",
        F.variant_get("METRICS", "$.TRAIN_ROWS", "bigint").alias("TRAIN_ROWS"),
        F.round(F.variant_get("METRICS", "$.TRAIN_MAE", "double"), 5).alias("TRAIN_MAE"),
        F.round(F.variant_get("METRICS", "$.FEATURE_IMPORTANCES.K", "double"), 5).alias("IMPORTANCE_K"),
    )


def daily_sides(spark, sf):
    panel = materialize(panels.daily_panel(spark, sf), "features")
    return train_test(time_split(panel, DAILY, TEST_PCT))


def gbt_models(train):
    return fit_models(train, DAILY, Boosted(), RUN_ID, VERSION, RUN_AT)


def train_models_gbt(spark, sf):
    return flat_metrics(gbt_models(daily_sides(spark, sf)[0]))


def metrics_by_feature_gbt(spark, sf):
    return rounded(metrics_long(gbt_models(daily_sides(spark, sf)[0]), DAILY), 5, "IMPORTANCE")


def score_gbt(spark, sf):
    train, test = daily_sides(spark, sf)
    return score(test, gbt_models(train), DAILY)


def eval_gbt(spark, sf):
    return evaluate(score_gbt(spark, sf), DAILY)


def gbt_sanity(spark, sf):
    """What must hold of default-size forests whatever their cuts: every series gets one, its rows
    are all counted, it beats the mean in sample, importances are shares, held-out rows are answered."""
    train, test = daily_sides(spark, sf)
    models = materialize(gbt_models(train), "models")
    spread = train.groupBy("PARTITION_ID").agg(F.stddev_pop("TARGET").alias("_spread"))
    answered = score(test, models, DAILY, "error").groupBy("PARTITION_ID").agg(F.count_if(~F.isnan("PREDICTION")).alias("ANSWERED"))
    shares = F.aggregate(F.map_values("METRICS.FEATURE_IMPORTANCES"), F.lit(0.0), lambda a, b: a + b)
    found = models.select(
        "PARTITION_ID", "STATUS", F.col("METRICS.TRAIN_ROWS").alias("TRAIN_ROWS"), F.col("METRICS.TRAIN_RMSE").alias("_rmse"),
        F.round(shares, 6).alias("SHARES"),
    )
    both = found.join(spread, "PARTITION_ID").join(answered, "PARTITION_ID", "left")
    return both.select("PARTITION_ID", "STATUS", "TRAIN_ROWS", "SHARES", "ANSWERED", (F.col("_rmse") < F.col("_spread") / 2).alias("BEATS_MEAN"))


def eval_colocated(spark, sf):
    """Fitted, scored and evaluated on tables that lie by series, with no shuffle of rows."""
    train, test = event_sides(spark, sf)
    mark, buckets = uuid.uuid4().hex, 4
    for name, side in (("train", train), ("test", test)):
        colocated.save_by_series(side, f"{name}_{mark}", "PARTITION_ID", buckets, scratch_path(spark, name))
    fitted = colocated.fit_here(f"train_{mark}", spark, EVENTS, Linear())
    models = fitted.withColumns({
        "ALGORITHM": F.lit("linear"), "FEATURE_COLS": F.array(F.lit("K"), F.lit("HOUR"))
    })
    colocated.save_by_series(models, f"models_{mark}", "PARTITION_ID", buckets, scratch_path(spark, "models"))
    found = colocated.evaluate_here(f"test_{mark}", f"models_{mark}", spark, EVENTS)
    return rounded(found.select("PARTITION_ID", "MAE", "RMSE", "ROWS"), 5, "MAE", "RMSE")


def score_gbt_stump(spark, sf):
    """One tree with one split per series: small enough to be checked in SQL."""
    train, test = event_sides(spark, sf)
    models = fit_models(train, EVENTS, STUMP, RUN_ID, VERSION, RUN_AT)
    return rounded(score(test, models, EVENTS), 4, "PREDICTION")


def score_gbt_small(spark, sf):
    """Four trees of three levels per series, the largest that SQL grows in reasonable time."""
    train, test = event_sides(spark, sf)
    models = fit_models(train, EVENTS, Boosted(rounds=4, depth=3), RUN_ID, VERSION, RUN_AT)
    return rounded(score(test, models, EVENTS), 4, "PREDICTION")


def train_long_series(spark, sf):
    """Few long series, fitted by aggregation and scored in parts, with a small task bound."""
    df = panels.tied_lines(spark, sf).select(
        F.col("l_returnflag").alias("PARTITION_ID"),
        F.col("l_shipdate").alias("TS"),
        F.col("l_quantity").alias("QUANTITY"),
        F.col("l_discount").alias("DISCOUNT"),
        F.col("l_tax").alias("TAX"),
        F.col("l_extendedprice").alias("TARGET"),
    )
    models = fit_models(df, BY_FLAG, STUMP, RUN_ID, VERSION, RUN_AT, max_task_rows=1_000)
    scored = score(df, models, BY_FLAG, max_task_rows=1_000)
    return scored.groupBy("PARTITION_ID", F.round("PREDICTION", 2).alias("PREDICTION")).agg(
        F.count("*").alias("ROWS")
    )


def udtf_train(spark, sf):
    return rounded(
        train_by_table_function(split_train(spark, sf), EVENTS, "K"), 6, "SLOPE", "INTERCEPT"
    )


def udtf_score(spark, sf):
    """Models of all features from the SQL table function, scored like any other."""
    panel = materialize(panels.events_panel(spark, sf), "features")
    train, test = train_test(time_split(panel, EVENTS, TEST_PCT))
    models = fit_models(train, EVENTS, STUMP, RUN_ID, VERSION, RUN_AT, fit_short=fit_by_table_function)
    scored = score(test, models, EVENTS).select("PARTITION_ID", "TS", "TARGET", "PREDICTION")
    return rounded(scored, 4, "PREDICTION")


def eval_merged(spark, sf):
    """Long series of a learner whose states are merged, fitted by all tasks and scored in parts."""
    df = panels.tied_lines(spark, sf).select(
        F.col("l_returnflag").alias("PARTITION_ID"),
        F.col("l_shipdate").alias("TS"),
        F.col("l_quantity").alias("QUANTITY"),
        F.col("l_discount").alias("DISCOUNT"),
        F.col("l_extendedprice").alias("TARGET"),
    )
    models = materialize(fit_models(df, BY_FLAG, Ridge(), RUN_ID, VERSION, RUN_AT, max_task_rows=500), "models")
    errors = rounded(evaluate(score(df, models, BY_FLAG, "error", (Ridge(),), 500), BY_FLAG), 4, "MAE", "RMSE")
    return errors.join(flat_metrics(models).select("PARTITION_ID", "ALGORITHM", "STATUS", "TRAIN_ROWS"), "PARTITION_ID")


def udtf_typed(spark, sf):
    """One registered table function, called on two panels of different width, types itself."""
    register_panel_fit(spark, Linear())
    train = materialize(split_train(spark, sf), "train")
    out = None
    for width, rows in ((1, train.drop("HOUR")), (2, train)):
        found = spark.sql("SELECT * FROM panel_fit(TABLE({rows}), 'PARTITION_ID', 'TS', 'TARGET')", rows=rows)
        hour = F.col("IMPORTANCE_HOUR") if width == 2 else F.lit(None).cast("double")
        part = found.select(
            F.lit(width).alias("WIDTH"), "PARTITION_ID", "TRAIN_ROWS", "TRAIN_MAE", "TRAIN_RMSE", "STATUS", "IMPORTANCE_K",
            hour.alias("IMPORTANCE_HOUR"),
        )
        out = part if out is None else out.unionByName(part)
    return rounded(out, 5, "TRAIN_MAE", "TRAIN_RMSE", "IMPORTANCE_K", "IMPORTANCE_HOUR")


# Catalog and registry


def active_catalog(train):
    rows = catalog.with_active(catalog.entries(linear_models(train), EVENTS, ROOT), EVENTS)
    return rows.select(
        "PARTITION_ID",
        "TRAINED_AT",
        "MODEL_VERSION",
        "IS_ACTIVE",
        "STAGE_PATH",
        F.col("METRICS.TRAIN_ROWS").alias("TRAIN_ROWS"),
    )


def catalog_build(spark, sf):
    return active_catalog(split_train(spark, sf))


def catalog_active_per_grain(spark, sf):
    versions = panels.version_log(spark, sf).select("PARTITION_ID", "TRAINED_AT", "MODEL_VERSION")
    return catalog.with_active(versions, EVENTS)


def catalog_latest_version(spark, sf):
    return catalog.latest_version(catalog_active_per_grain(spark, sf))


def run_versions(spark, sf):
    return panels.version_log(spark, sf).select(
        "PARTITION_ID",
        "MODEL_VERSION",
        "RUN_ID",
        text.inference_run_id(F.col("TRAINED_AT")).alias("INFERENCE_RUN_ID"),
        F.date_format("TRAINED_AT", "yyyy-MM-dd").alias("TRAINED_ON"),
    )


def path_catalog(spark, sf):
    """Active and inactive versions of customers with their paths."""
    rows = panels.version_log(spark, sf)
    path = F.concat_ws("/", F.lit(ROOT), "RUN_ID", "PARTITION_ID")
    return catalog.with_active(rows.withColumn("STAGE_PATH", path), EVENTS)


def staged_names(spark, sf):
    """A listing with two files per version: a model and its metrics."""
    files = F.explode(F.array(F.lit("model.pkl"), F.lit("metrics.parquet")))
    rows = panels.version_log(spark, sf).withColumn("FILE", files)
    return rows.select(F.concat_ws("/", F.lit("stage"), "RUN_ID", "PARTITION_ID", "FILE").alias("NAME"))


def version_of_run(spark, sf):
    """The one version of each run."""
    return catalog.single_value(panels.version_log(spark, sf), "RUN_ID", "MODEL_VERSION")


def times_from_text(spark, sf):
    """Order times written as text, every seventh with a fault, and read again."""
    written = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")
    faulty = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("on "), written)).otherwise(written)
    return parquet_table(spark, sf, "orders").select(
        "o_orderkey", calendar.parse_time(faulty, "dd.MM.yyyy HH:mm").alias("TS")
    )


def artifact_paths(spark, sf):
    return catalog.artifact_paths(staged_names(spark, sf), "NAME", "model.pkl", "PARTITION_ID", 1)


def all_customers(spark, sf):
    """All customers, those without an order included."""
    return parquet_table(spark, sf, "customer").select(
        text.series_id("C", F.col("c_custkey"), 6).alias("PARTITION_ID"), "c_acctbal"
    )


def catalog_attach_paths(spark, sf):
    active = path_catalog(spark, sf).filter("IS_ACTIVE").select("PARTITION_ID", "STAGE_PATH").distinct()
    return catalog.attach_paths(all_customers(spark, sf), active, EVENTS)


def catalog_without_artifact(spark, sf):
    """Customers whose active version is not an urgent one, or who have none."""
    active = path_catalog(spark, sf).filter("IS_ACTIVE AND o_orderpriority = '1-URGENT'")
    return catalog.without_artifact(all_customers(spark, sf), active, EVENTS)


def manifest_map(spark, sf):
    maps = catalog.manifest(materialize(catalog_build(spark, sf), "catalog"), EVENTS)
    return maps.select(F.explode("PATHS").alias("PARTITION_ID", "STAGE_PATH"))


def rows_to_score(spark, sf):
    train, test = event_sides(spark, sf)
    ready = active_catalog(train).filter(F.col("TRAIN_ROWS") >= MIN_TRAIN_ROWS)
    return catalog.rows_to_score(test, ready, EVENTS)


def registry_default_version(spark, sf):
    rows = panels.version_log(spark, sf).select(
        F.col("o_orderpriority").alias("MODEL_NAME"),
        "MODEL_VERSION",
        "RUN_ID",
        F.lit("").alias("SIGNATURE"),
        F.col("TRAINED_AT").alias("CREATED_AT"),
    )
    return registry.default_versions(rows).drop("SIGNATURE")


def registry_conform(spark, sf):
    """Rows cast to the signature a registered model expects."""
    panel = panels.events_panel(spark, sf)
    typed = registry.conform(panel, registry.input_signature(panel, EVENTS))
    numbers = [f.name for f in typed.schema if isinstance(f.dataType, T.FloatType)]
    return typed.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in numbers})


# Artifacts and jobs


def stage_models(models: DataFrame) -> tuple[DataFrame, str]:
    """Catalog rows of the models, and the folder in which their artifacts lie."""
    models = materialize(models, "models")
    folder = scratch_path(models.sparkSession, "artifacts")
    rows = materialize(catalog.with_active(catalog.entries(models, EVENTS, ROOT, None, folder), EVENTS), "catalog")
    artifacts.write_artifacts(models, rows, folder, "PARTITION_ID")
    return rows, folder


def score_by_path(spark, sf):
    """Trained, stored as artifacts, catalogued, loaded from the paths in the catalog and scored."""
    train, test = event_sides(spark, sf)
    rows, _ = stage_models(linear_models(train))
    loaded = artifacts.open_artifacts(rows.filter("IS_ACTIVE"), "PARTITION_ID")
    return rounded(score(test, materialize(loaded, "loaded"), EVENTS, "error"), 5, "PREDICTION")


def artifact_reload(spark, sf):
    """All artifacts of a run, read back by the data source."""
    _, folder = stage_models(linear_models(split_train(spark, sf)))
    metrics = F.from_json("METRICS", "TRAIN_ROWS long, TRAIN_MAE double")
    found = artifacts.read_artifacts(spark, folder).select(
        "SERIES", "ALGORITHM", F.concat_ws(",", "FEATURE_COLS").alias("FEATURES"),
        text.path_part(F.col("STAGE_PATH"), 1).alias("LAST"), metrics.alias("m"),
    )
    return found.select("SERIES", "ALGORITHM", "FEATURES", "LAST", "m.TRAIN_ROWS", F.round("m.TRAIN_MAE", 5).alias("TRAIN_MAE"))


def missing_artifacts(spark, sf):
    """Catalogued series whose path has no artifact: those with too few rows to be stored."""
    models = materialize(linear_models(split_train(spark, sf)), "models")
    _, folder = stage_models(models.filter(F.col("METRICS.TRAIN_ROWS") >= MIN_TRAIN_ROWS))
    every = catalog.entries(models, EVENTS, ROOT, None, folder)
    opened = artifacts.open_artifacts(every, "PARTITION_ID", "drop")
    return opened.filter("MODEL_BINARY IS NULL").select("PARTITION_ID")


def job_predictions(spark, sf):
    """The two jobs, end to end; models by the registered version."""
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    panel = materialize(panels.short_panel(spark, sf), "features")
    run_training(ws, panel, EVENTS, Linear(), TEST_PCT, at=RUN_AT)
    test = train_test(ws.table("split", RUN_ID))[1]
    run_id = run_inference(ws, test, EVENTS, at=RUN_AT)
    return rounded(ws.table("predictions", run_id), 5, "PREDICTION")


def job_catalog(spark, sf):
    """What a workspace shows after two models were trained at the same time and a third run died."""
    ws = Workspace(spark, scratch_path(spark, "workspace"))
    panel = materialize(panels.short_panel(spark, sf), "features")
    for name in ("demand", "price"):
        run_training(ws, panel, EVENTS, Linear(), TEST_PCT, at=RUN_AT, model_name=name)
    try:
        run_training(ws, panel, EVENTS, Linear(), TEST_PCT, at=RUN_AT, model_name="lost", max_failed=-1.0)
    except RuntimeError:
        pass
    runs = ws.table("run_log").select("RUN_ID", "JOB")
    entries = ws.table("catalog").groupBy("MODEL_NAME", "MODEL_VERSION", "RUN_ID").agg(F.count("*").alias("MODELS"))
    return entries.join(runs, "RUN_ID")


# Scoring


def ready_models(train):
    return linear_models(train).filter(F.col("METRICS.TRAIN_ROWS") >= MIN_TRAIN_ROWS)


def score_drop_missing(spark, sf):
    train, test = event_sides(spark, sf)
    return rounded(score(test, ready_models(train), EVENTS), 5, "PREDICTION")


def score_strict(spark, sf):
    train, test = event_sides(spark, sf)
    return rounded(score(test, linear_models(train), EVENTS, "error"), 5, "PREDICTION")


def registry_answers(train, test):
    return registry_output(score(test.drop("TARGET"), linear_models(train), EVENTS, "error"), EVENTS)


def score_registry(spark, sf):
    answers = registry_answers(*event_sides(spark, sf))
    return answers.withColumn("PRED_TARGET", F.round(F.col("PRED_TARGET").cast("double"), 3))


def predictions_join_actuals(spark, sf):
    train, test = event_sides(spark, sf)
    joined = join_actuals(registry_answers(train, test), test, EVENTS)
    return joined.withColumn("PREDICTION", F.round(F.col("PREDICTION").cast("double"), 3))


def predictions_paired(spark, sf):
    """Lines of a supplier and day, each answer with one actual although many share the day; every
    ninth has no day."""
    day = F.when(F.col("l_orderkey") % 9 != 0, F.col("l_shipdate"))
    lines = panels.tied_lines(spark, sf).select("l_suppkey", day.alias("l_shipdate"), "l_quantity", "l_extendedprice")
    answers = lines.select(
        F.col("l_suppkey").alias("OUTPUT_l_suppkey"),
        F.col("l_shipdate").alias("OUTPUT_l_shipdate"),
        F.col("l_quantity").alias("PRED_l_extendedprice"),
    )
    return pair_actuals(answers, lines, TIED)


def scoring_coverage(spark, sf):
    train, test = event_sides(spark, sf)
    return coverage(test, score(test, ready_models(train), EVENTS), EVENTS)


def missing_models(spark, sf):
    train, test = event_sides(spark, sf)
    return missing_model_rows(test, ready_models(train), EVENTS)


def eval_linear(spark, sf):
    train, test = event_sides(spark, sf)
    return rounded(evaluate(score(test, linear_models(train), EVENTS), EVENTS), 5, "MAE", "RMSE")


def sample_predictions(spark, sf):
    coef, test = linreg_sides(spark, sf)
    return rounded(preview(predict_linear(test, coef, EVENTS), EVENTS), 5, "PREDICTION")


# Staged files


def export_reload(spark, sf):
    panel = panels.short_panel(spark, sf)
    path = scratch_path(spark, "export")
    staging.export_by_series(panel, path, "PARTITION_ID")
    return staging.load_by_name(spark, path, panel.schema)


def load_by_name(spark, sf):
    """Other case, another order, a column less, and one that no file has."""
    path = scratch_path(spark, "export")
    staging.export_by_series(panels.short_panel(spark, sf), path, "PARTITION_ID")
    schema = T.StructType.fromDDL("target double, absent string, partition_id string, ts timestamp_ntz")
    return staging.load_by_name(spark, path, schema)


def load_ledger(spark, sf):
    """Staged files loaded, loaded again, and once more with new ones among them: every row once."""
    panel = panels.short_panel(spark, sf)
    path, late = scratch_path(spark, "export"), F.hour("TS") >= 18
    table = LoadedTable(spark, scratch_path(spark, "loaded"), panel.schema)
    staging.export_by_series(panel.filter(~late), f"{path}/first", "PARTITION_ID")
    table.load(path)
    table.load(path)
    staging.export_by_series(panel.filter(late), f"{path}/second", "PARTITION_ID")
    table.load(path)
    return table.rows()


def staged_series(spark, sf):
    """Series found by listing the exported folders."""
    path = scratch_path(spark, "export")
    staging.export_by_series(panels.short_panel(spark, sf), path, "PARTITION_ID")
    folder = text.path_part(text.artifact_dir(F.col("NAME")), 1)
    names = staging.list_files(spark, path, "*.parquet").select(
        F.regexp_replace(folder, "^SERIES=", "").alias("PARTITION_ID")
    )
    return names.distinct()


# Generation


def order_spine(spark, sf, step):
    per_customer = parquet_table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.count("*").alias("n")
    )
    return generate.spine(per_customer, F.col("first"), step, F.col("n")).select("o_custkey", "STEP", "TS")


def spine_daily(spark, sf):
    return order_spine(spark, sf, "day")


def spine_monthly(spark, sf):
    return order_spine(spark, sf, "month")


def spine_units(spark, sf):
    """Every step size, from each supplier's own number of steps and a month-end origin."""
    suppliers = parquet_table(spark, sf, "supplier").select("s_suppkey", (F.col("s_nationkey") + 1).alias("n"))
    origin = F.lit(dt.date(2024, 1, 31)).cast("timestamp_ntz")
    out = None
    for unit in calendar.TIMESTEPS:
        part = generate.spine(suppliers, origin, unit, F.col("n")).select(
            "s_suppkey", F.lit(unit).alias("UNIT"), "STEP", "TS"
        )
        out = part if out is None else out.unionByName(part)
    return out


def supplier_ids(spark, sf):
    return parquet_table(spark, sf, "supplier").select(
        text.series_id("P", F.col("s_suppkey")).alias("PARTITION_ID")
    )


def supplier_scaffold(spark, sf):
    return generate.scaffold(supplier_ids(spark, sf), EVENTS, dt.date(2024, 3, 2), "day", 730)


def panel_scaffold(spark, sf):
    return supplier_scaffold(spark, sf)


def seasonal_features(spark, sf):
    day = F.col("o_orderdate")
    parts = {
        "SEASONAL": calendar.seasonal(day),
        "WEEKDAY_EFFECT": calendar.weekday_effect(day),
        "DOY_RATIO": calendar.day_of_year_ratio(day),
        "DOW_RATIO": calendar.weekday_ratio(day),
    }
    return parquet_table(spark, sf, "orders").select(
        "o_orderkey", *[F.round(v, 6).alias(k) for k, v in parts.items()]
    )


def panel_generate(spark, sf):
    return generate.feature_table(supplier_scaffold(spark, sf), EVENTS, 6)


def panel_generate_summary(spark, sf):
    return generate.summary(panel_generate(spark, sf), EVENTS)


# Usage


def usage_by_size(spark, sf):
    return usage.exec_seconds_by_size(panels.query_log(spark, sf), "QUERY_TAG")


def usage_of_tag(spark, sf):
    return usage.exec_seconds_by_size(usage.tagged(panels.query_log(spark, sf), "purchase"))


def usage_of_tag_sql(spark, sf):
    """``usage_of_tag`` as SQL text with a bound parameter."""
    return spark.sql(
        """SELECT WAREHOUSE_SIZE, sum(EXECUTION_TIME) / 1000.0D AS TOTAL_EXEC_SECS FROM {log}
           WHERE WAREHOUSE_SIZE IS NOT NULL AND QUERY_TAG = :tag GROUP BY WAREHOUSE_SIZE""",
        args={"tag": "purchase"},
        log=panels.query_log(spark, sf),
    )


def wh_credits(spark, sf):
    used = usage.warehouse_units(panels.query_log(spark, sf), "QUERY_TAG")
    return used.select("QUERY_TAG", usage.rounded_credits(F.col("UNITS")).alias("CREDITS"))


def container_credits(spark, sf):
    cost = usage.rounded_credits(F.col("UNITS")).alias("CREDITS")
    runs = usage.container_runs(panels.run_log(spark, sf))
    return runs.select("RUN_ID", "INSTANCE_FAMILY", "NODES", "MICROS", cost)


def run_durations(spark, sf):
    seconds = calendar.seconds_between(F.col("STARTED"), F.col("ENDED"))
    return panels.run_log(spark, sf).select(
        "RUN_ID", seconds.alias("SECONDS"), (seconds / F.lit(60.0)).alias("MINUTES")
    )


def usage_summary(spark, sf):
    return usage.summary(panels.run_log(spark, sf), panels.query_log(spark, sf))


def usage_overview(spark, sf):
    return usage.overview(panels.run_log(spark, sf), panels.query_log(spark, sf))


def logged_jobs(spark, sf):
    """Events written as lines of an event log: a job each, with two tasks; two events a query.

    A job also lists a stage of the job before it, as jobs do that skip what has run.
    """
    job = F.col("event_id")
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    ms = F.round(F.col("value") * 1000).cast("long")
    prefix = "spark-session-01234567-89ab-cdef-0123-456789abcdef"
    tags = F.concat(
        F.lit(f"{prefix}-execution-root-id-7,{prefix}-thread-01234567-89ab-cdef-0123-456789abcdef-"), "event_type", F.lit(f",{prefix}")
    )
    properties = F.map_from_arrays(
        F.array(F.lit("spark.job.tags"), F.lit("spark.sql.execution.root.id")), F.array(tags, F.floor(job / 2).cast("string"))
    )

    def line(kind: str, **fields):
        named = [v.alias(k.replace("_", " ")) for k, v in fields.items()]
        return F.to_json(F.struct(F.lit(f"SparkListener{kind}").alias("Event"), *named))

    def task(stage, run):
        return line("TaskEnd", Stage_ID=stage, Task_Metrics=F.struct(run.alias("Executor Run Time"), (run * 500_000).alias("Executor CPU Time")))

    lines = [
        line("JobStart", Job_ID=job, Submission_Time=start, Stage_IDs=F.array(2 * job - 1, 2 * job, 2 * job + 1), Properties=properties),
        task(2 * job, ms),
        task(2 * job + 1, F.lit(3)),
        line("JobEnd", Job_ID=job, Completion_Time=start + ms, Job_Result=F.struct(F.lit("JobSucceeded").alias("Result"))),
        line("ExecutorAdded", Timestamp=start),
    ]
    return parquet_table(spark, sf, "events").select(F.explode(F.array(*lines)).alias("value"))


def usage_of_event_log(spark, sf):
    """Use of each tag, from Spark's own records."""
    path = scratch_path(spark, "events")
    logged_jobs(spark, sf).repartition(4).write.text(path)
    # The lines lie in several files here; one application wrote them.
    events = event_log.read_events(spark, path).withColumn("APP", F.lit("app"))
    return event_log.queries(events).groupBy("QUERY_TAG").agg(
        F.count("*").alias("QUERIES"), F.sum("JOBS").alias("JOBS"), F.sum("EXECUTION_TIME").alias("EXECUTION_TIME"),
        F.sum("TASK_TIME").alias("TASK_TIME"), F.sum("CPU_TIME").alias("CPU_TIME"), F.count_if("FAILED").alias("FAILED"),
    )


def run_id_from_log(spark, sf):
    """Run ids printed into the logs of assistant turns; other turns have none."""
    line = F.concat(F.col("text"), F.lit("\nRUN_ID=training_"), F.col("conv_id").cast("string"), F.lit(" \ndone"))
    log = F.when(F.col("role") == "assistant", line).otherwise(F.col("text"))
    return parquet_table(spark, sf, "conversations").select(
        "conv_id", "turn", text.run_id_in(log).alias("RUN_ID")
    )


QUERIES = [
    panel_build_daily,
    panel_features_events,
    panel_model_input,
    panel_summary,
    rows_per_partition,
    rank_in_time_events,
    rank_in_time_ties,
    split_train,
    split_test,
    split_ties,
    split_daily,
    split_cutoffs,
    split_counts,
    split_boundaries,
    split_roundtrip,
    summary_appended,
    split_appended,
    linreg_fit,
    linreg_predict,
    linreg_eval,
    train_models_linear,
    metrics_by_feature,
    metrics_variant,
    train_models_gbt,
    metrics_by_feature_gbt,
    score_gbt,
    eval_gbt,
    gbt_sanity,
    eval_colocated,
    score_gbt_stump,
    score_gbt_small,
    train_long_series,
    udtf_train,
    udtf_score,
    udtf_typed,
    eval_merged,
    catalog_build,
    catalog_active_per_grain,
    catalog_latest_version,
    run_versions,
    version_of_run,
    times_from_text,
    artifact_paths,
    catalog_attach_paths,
    catalog_without_artifact,
    manifest_map,
    rows_to_score,
    registry_default_version,
    registry_conform,
    score_by_path,
    artifact_reload,
    missing_artifacts,
    job_predictions,
    job_catalog,
    score_drop_missing,
    score_strict,
    score_registry,
    predictions_join_actuals,
    predictions_paired,
    scoring_coverage,
    missing_models,
    eval_linear,
    sample_predictions,
    export_reload,
    load_by_name,
    load_ledger,
    staged_series,
    spine_daily,
    spine_monthly,
    spine_units,
    panel_scaffold,
    seasonal_features,
    panel_generate,
    panel_generate_summary,
    usage_by_size,
    usage_of_tag,
    usage_of_tag_sql,
    wh_credits,
    container_credits,
    run_durations,
    usage_summary,
    usage_overview,
    usage_of_event_log,
    run_id_from_log,
]


def queries():
    return {q.__name__: q for q in QUERIES}

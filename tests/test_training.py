import datetime as dt
import sys
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidecast.operators.learners import Boosted, Linear
from tidecast.operators.scoring import (
    evaluate,
    join_actuals,
    missing_model_rows,
    registry_output,
    score,
)
from tidecast.operators.training import fit_models, metrics_long
from tidecast.spec import PanelSpec

# Workers cannot import this file, so its learner travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPEC = PanelSpec()
RUN = ("training_v1", "v1", dt.datetime(2024, 3, 2, 12, 0))
SCHEMA = "PARTITION_ID string, TS timestamp_ntz, A double, B double, TARGET double"


def panel(spark, sizes=(("p1", 60), ("p2", 80)), seed=3, holes=True):
    rng = np.random.default_rng(seed)
    rows = []
    for grain, n in sizes:
        for i in range(n):
            a, b = float(rng.normal(5, 2)), float(rng.integers(0, 4))
            y = 3 * a + 2 * b * (a > 5) + float(rng.normal(0, 0.1))
            hole = holes and i % 11 == 0
            ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((grain, ts, None if hole else a, b, y))
    return spark.createDataFrame(rows, SCHEMA)


def arrays(df, grain):
    pdf = df.filter(F.col("PARTITION_ID") == grain).toPandas().sort_values("TS")
    return pdf[["A", "B"]].to_numpy(np.float32), pdf["TARGET"].to_numpy(np.float32)


def test_boosted_recovers_a_step_and_its_importances():
    X = np.linspace(0, 1, 200, dtype=np.float32)[:, None]
    X = np.column_stack([X, np.zeros(200, np.float32)])
    y = np.where(X[:, 0] >= 0.5, 10.0, -10.0)
    learner = Boosted(rounds=60)
    blob, importances = learner.fit(X, y)
    assert np.abs(learner.predict(learner.load(blob), X) - y).max() < 0.05
    assert importances.tolist() == [1.0, 0.0]


def series_of_all_kinds():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 40, 41, 300, 39, 3, 120):
        X = rng.integers(0, 30, (n, 3)).astype(np.float32)
        X[rng.random(X.shape) < 0.1 * (n % 2)] = np.nan
        y = X[:, 0] * 2 + rng.normal(size=n)
        y[1:2] = np.nan
        yield X, y.astype(np.float32)


def test_series_fitted_together_get_the_trees_they_get_alone():
    learner, series = Boosted(rounds=7), list(series_of_all_kinds())
    together = learner.fit_many(series)
    for (blob, importances), (X, y) in zip(together, series):
        alone, shares = learner.fit(X, y)
        assert importances.tolist() == shares.tolist()
        got, want = learner.load(blob), learner.load(alone)
        assert all(np.array_equal(got[k], want[k]) for k in want)


@dataclass(frozen=True)
class OnlyTogether(Boosted):
    """Cannot fit a series alone, and none of one row."""

    rounds: int = 2
    name: str = "gbt"

    def fit(self, X, y):
        raise ValueError("alone")

    def fit_many(self, series):
        if any(len(y) == 1 for _, y in series):
            raise ValueError("one row")
        return super().fit_many(series)


def test_short_series_reach_the_learner_together_and_failures_stay_apart(spark):
    name = F.concat(F.lit("p"), F.col("id") % 400)
    day = F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz")
    df = spark.range(8000).select(name.alias("PARTITION_ID"), day.alias("TS"), (F.col("id") % 7).cast("double").alias("A"), F.rand(1).alias("TARGET"))
    fitted = fit_models(df, SPEC, OnlyTogether(), *RUN)
    assert {(r.STATUS, r.METRICS.TRAIN_ROWS) for r in fitted.collect()} == {("ok", 20)} and fitted.count() == 400
    bad = df.withColumn("TARGET", F.when(F.col("PARTITION_ID") != "p1", F.col("TARGET")))
    found = {r.PARTITION_ID: r.STATUS for r in fit_models(bad, SPEC, Boosted(rounds=2), *RUN).collect()}
    assert len(found) == 400 and [k for k, v in found.items() if v == "error"] == ["p1"]


def test_boosted_error_falls_with_rounds_and_handles_edge_targets():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 4)).astype(np.float32)
    X[rng.random(X.shape) < 0.1] = np.nan
    y = np.nan_to_num(X[:, 0]) ** 2 + np.nan_to_num(X[:, 1])
    errors = []
    for rounds in (1, 5, 20, 60):
        learner = Boosted(rounds=rounds)
        blob, importances = learner.fit(X, y)
        errors.append(np.mean((learner.predict(learner.load(blob), X) - y) ** 2))
        assert importances.sum() == pytest.approx(1.0)
    assert errors == sorted(errors, reverse=True)
    blob, importances = Boosted(rounds=3).fit(X, np.full(300, 7.5))
    assert importances.sum() == 0
    assert np.allclose(Boosted().predict(Boosted().load(blob), X), 7.5)


def test_first_split_is_the_best_of_all_thresholds():
    rng = np.random.default_rng(5)
    X = rng.integers(0, 12, size=(90, 3)).astype(np.float32)
    y = rng.normal(size=90) + (X[:, 1] > 6) * 2
    learner = Boosted(rounds=1, depth=1)
    model = learner.load(learner.fit(X, y)[0])
    g = y.mean() - y
    best = (-1.0, None, None)
    for f in range(3):
        for v in np.unique(X[:, f])[1:]:
            left = X[:, f] < v
            parts = [g[left], g[~left]]
            gain = sum(p.sum() ** 2 / (len(p) + 1) for p in parts) - g.sum() ** 2 / 91
            if gain > best[0] + 1e-9:
                best = (gain, f, v)
    assert (model["feat"][0, 0], model["threshold"][0, 0]) == best[1:]


@pytest.mark.parametrize("holes", [True, False])
def test_large_series_get_the_trees_of_the_in_task_fit(spark, holes):
    df = panel(spark, holes=holes)
    learner = Boosted(rounds=3, depth=3)
    inside = fit_models(df, SPEC, learner, *RUN).toPandas().set_index("PARTITION_ID")
    spread = fit_models(df, SPEC, learner, *RUN, max_task_rows=70).toPandas().set_index("PARTITION_ID")
    assert sorted(spread.index) == ["p1", "p2"] and (spread["STATUS"] == "ok").all()
    one, two = (learner.load(m.loc["p2", "MODEL_BINARY"]) for m in (inside, spread))
    for name in ("feat", "threshold", "miss"):
        assert (one[name] == two[name]).all(), name
    assert np.allclose(one["value"], two["value"], atol=1e-5)
    a, b = inside.loc["p2", "METRICS"], spread.loc["p2", "METRICS"]
    for name in ("TRAIN_MAE", "TRAIN_RMSE", "TRAIN_ROWS"):
        assert a[name] == pytest.approx(b[name], rel=1e-5)
    assert a["FEATURE_IMPORTANCES"] == pytest.approx(b["FEATURE_IMPORTANCES"], rel=1e-5)


def test_large_series_without_splits_or_targets_keep_their_row(spark):
    df = panel(spark, sizes=(("flat", 40), ("void", 40), ("p1", 40)))
    target = F.when(F.col("PARTITION_ID") == "flat", 2.5).when(F.col("PARTITION_ID") == "p1", F.col("TARGET"))
    df = df.withColumn("TARGET", target)
    learner = Boosted(rounds=2, depth=2)
    got = {r.PARTITION_ID: r for r in fit_models(df, SPEC, learner, *RUN, max_task_rows=10).collect()}
    assert set(got) == {"flat", "void", "p1"}
    assert (got["void"].STATUS, got["void"].ERROR) == ("error", "no row with a target")
    assert got["flat"].STATUS == "ok" and got["flat"].METRICS.TRAIN_MAE == pytest.approx(0)
    model = learner.load(got["flat"].MODEL_BINARY)
    assert model["base"] == 2.5 and (model["feat"] == -1).all() and not model["value"].any()


@pytest.mark.parametrize("learner", [Linear(), Boosted(rounds=5)])
def test_models_do_not_depend_on_shuffle_partitions(spark, learner):
    df = panel(spark)
    blobs = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "4", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            models = fit_models(df.repartition(int(n)), SPEC, learner, *RUN)
            scored = score(df, models, SPEC).orderBy("PARTITION_ID", "TS").toPandas()
            blobs.append(scored["PREDICTION"].to_numpy())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in blobs[1:]:
        assert np.allclose(blobs[0], other, rtol=1e-9, equal_nan=True)


def test_linear_panel_fit_equals_least_squares(spark):
    df = panel(spark)
    models = fit_models(df, SPEC, Linear(), *RUN).toPandas().set_index("PARTITION_ID")
    for grain in ("p1", "p2"):
        X, y = arrays(df, grain)
        blob, importances = Linear().fit(X, y)
        assert np.allclose(np.frombuffer(models.loc[grain, "MODEL_BINARY"]), np.frombuffer(blob))
        got = models.loc[grain, "METRICS"]
        assert list(got["FEATURE_IMPORTANCES"].values()) == pytest.approx(list(importances))
        assert got["TRAIN_ROWS"] == len(y)
        miss = Linear().predict(np.frombuffer(blob), X) - y
        assert got["TRAIN_MAE"] == pytest.approx(np.nanmean(np.abs(miss)), rel=1e-6)


class Average:
    """A user's own learner."""

    name = "average"

    def fit(self, X, y):
        if len(y) < 10:
            raise ValueError("too short")
        return np.float64(y.mean()).tobytes(), np.zeros(X.shape[1])

    def load(self, blob):
        return np.frombuffer(blob)[0]

    def predict(self, model, X):
        return np.full(len(X), model)


def test_own_learner_error_rows_and_policies(spark):
    df = panel(spark, sizes=(("p1", 60), ("tiny", 4)))
    models = fit_models(df, SPEC, Average(), *RUN).persist()
    status = {r.PARTITION_ID: (r.STATUS, r.ERROR) for r in models.collect()}
    assert status["p1"] == ("ok", None)
    assert status["tiny"] == ("error", "ValueError: too short")
    kept = score(df, models, SPEC, learners=(Average(),))
    assert kept.columns == ["PARTITION_ID", "TS", "TARGET", "PREDICTION"]
    assert kept.count() == 60
    assert missing_model_rows(df, models, SPEC).count() == 4
    with pytest.raises(Exception, match="series tiny has rows to score but no model"):
        score(df, models, SPEC, "error", learners=(Average(),)).count()
    with pytest.raises(ValueError):
        score(df, models, SPEC, "guess")
    long = {r.PARTITION_ID: r for r in fit_models(df, SPEC, Average(), *RUN, max_task_rows=50).collect()}
    assert {k: r.STATUS for k, r in long.items()} == {"p1": "ok", "tiny": "error"}
    assert "60 rows, more than 50" in long["p1"].WARNING and long["tiny"].WARNING is None


def test_continuous_values_get_the_same_cuts_both_ways(spark):
    noise = (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)).cast("double")
    df = spark.range(120_000).select(
        F.lit("p").alias("PARTITION_ID"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("TS"),
        noise.alias("A"),
        F.when(F.col("id") % 10 > 0, F.sin("id")).alias("B"),
        (F.floor(noise * 700) + F.coalesce(F.sin("id"), F.lit(0.0)) * 50).alias("TARGET"),
    )
    learner = Boosted(rounds=1, depth=3)
    one, two = (
        learner.load(fit_models(df, SPEC, learner, *RUN, max_task_rows=n).first().MODEL_BINARY) for n in (200_000, 50_000)
    )
    for name in ("feat", "threshold", "miss"):
        assert (one[name] == two[name]).all(), name


def test_boosted_refuses_sizes_that_do_not_fit_its_types():
    for wrong in ({"max_bin": 40_000}, {"depth": 17}, {"rounds": 0}):
        with pytest.raises(ValueError):
            Boosted(**wrong)


def test_long_series_are_scored_in_parts_with_copies_whole(spark):
    df = panel(spark)
    models = fit_models(df, SPEC, Boosted(rounds=3), *RUN).persist()
    rows = df.unionByName(df.filter("PARTITION_ID = 'p2'").limit(1).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("c"))
    whole = score(rows, models, SPEC)
    parts = score(rows, models, SPEC, max_task_rows=25)
    assert whole.count() == 180
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_feature_order_and_extra_columns_do_not_matter(spark):
    df = panel(spark)
    models = fit_models(df, SPEC, Boosted(rounds=3), *RUN).persist()
    shuffled = df.select("B", "TARGET", F.lit(1.0).alias("EXTRA"), "A", "TS", "PARTITION_ID")
    a, b = score(df, models, SPEC), score(shuffled, models, SPEC)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_registry_form_joins_back_to_actuals(spark):
    df = panel(spark)
    models = fit_models(df, SPEC, Linear(), *RUN).persist()
    answers = registry_output(score(df.drop("TARGET"), models, SPEC), SPEC)
    assert answers.columns == ["OUTPUT_PARTITION_ID", "OUTPUT_TS", "PRED_TARGET"]
    joined = join_actuals(answers, df, SPEC)
    assert joined.columns == ["PARTITION_ID", "TS", "TARGET", "PREDICTION"] and joined.count() == 140


def test_evaluation_and_long_metrics(spark):
    df = panel(spark, holes=False)
    models = fit_models(df, SPEC, Boosted(rounds=10), *RUN).persist()
    train = {r.PARTITION_ID: r.METRICS for r in models.collect()}
    for r in evaluate(score(df, models, SPEC), SPEC).collect():
        assert r.MAE == pytest.approx(train[r.PARTITION_ID].TRAIN_MAE, rel=1e-5)
        assert r.ROWS == train[r.PARTITION_ID].TRAIN_ROWS
    long = metrics_long(models, SPEC)
    assert long.count() == 4
    total = long.groupBy("PARTITION_ID").agg(F.sum("IMPORTANCE").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in total)

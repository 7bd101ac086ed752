"""Boosted trees for series too long for one task, as Spark aggregations.

Trees on squared error need only sums of gradients per (node, feature, bin). Rows of a
series with equal bins always share a prediction, so they are merged once into cells,
and each tree level is one aggregation over the cells. Partial sums are combined before
the shuffle: what reaches a task per series depends on bins and nodes, not on rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.operators.ranking import range_ends
from tidecast.session import MAX_TASK_ROWS, materialize
from tidecast.spec import PanelSpec

MISSING = -1
TREES_PER_CHECKPOINT = 10
# Columns of a tree in heap order, with their value where a node does not split.
TREE_COLUMNS = {"_feat": -1, "_cut": 0, "_miss": False, "_gain": 0.0}


def bin_cuts(rows: DataFrame, spec: PanelSpec, features: list[str], max_bin: int) -> DataFrame:
    """Base value and ascending thresholds per feature of each series, those of the in-task fit.

    Equal values are merged, and the running count of each tells whether it holds one of the
    ``max_bin`` quantiles. A series' values are spread over ranges, never sorted in one task.
    """
    group = F.struct(spec.grain, "_feature").alias("_group")
    runs = (
        rows.select(spec.grain, F.posexplode(F.array(*features)).alias("_feature", "_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy(spec.grain, "_feature", "_value")
        .agg(F.count("*").alias("_copies"))
        .select(group, "_value", "_copies")
    )
    ends = materialize(range_ends(runs, "_group", "_value", "_copies"), "value-ends")
    whole = ends.groupBy("_group").agg(F.max("_end").alias("_all"), F.min("_value").alias("_least"))

    def holds(k: Column) -> Column:
        place = F.ceil(k / F.lit(float(max_bin)) * F.col("_all"))
        return k.between(1, max_bin) & (place > F.col("_end") - F.col("_copies")) & (place <= F.col("_end"))

    last = F.floor(F.col("_end") * F.lit(float(max_bin)) / F.col("_all"))
    cuts = (
        ends.join(materialize(whole, "value-counts"), "_group")
        .filter(F.col("_value") > F.col("_least"))
        .filter(holds(last - 1) | holds(last) | holds(last + 1))
        .groupBy("_group")
        .agg(F.array_sort(F.collect_list("_value")).alias("_cuts"))
    )
    by_feature = cuts.groupBy(F.col("_group")[spec.grain].alias(spec.grain)).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("_group._feature"), "_cuts"))).alias("_found")
    )
    none = F.array().cast("array<float>")
    lists = F.array(*[F.coalesce(F.col("_found")[i], none) for i in range(len(features))])
    base = rows.groupBy(spec.grain).agg(F.avg(spec.target).alias("_base"))
    return base.join(by_feature, spec.grain, "left").select(
        spec.grain, "_base", F.coalesce(lists, F.array_repeat(none, len(features))).alias("_cuts")
    )


def cells_of(rows: DataFrame, cuts: DataFrame, spec: PanelSpec, features: list[str]) -> DataFrame:
    """Rows merged by series and bins: how many, and the sum of their targets."""

    def bin_of(i: int, c: str) -> Column:
        passed = F.size(F.filter(F.col("_cuts")[i], lambda v: v <= F.col(c)))
        return F.when(F.col(c).isNull(), F.lit(MISSING)).otherwise(passed)

    bins = F.array(*[bin_of(i, c) for i, c in enumerate(features)])
    return (
        rows.join(cuts, spec.grain)
        .select(spec.grain, "_base", bins.alias("_bins"), spec.target)
        .groupBy(spec.grain, "_base", "_bins")
        .agg(F.count("*").alias("_n"), F.sum(spec.target).alias("_y"))
        .select(spec.grain, "_bins", "_n", "_y", F.col("_base").alias("_pred"))
    )


def node_after(levels: int) -> Column:
    """Heap position of a cell after ``levels`` splits of the tree on the same row."""
    if levels == 0:
        return F.lit(0)

    def step(at: Column, _: Column) -> Column:
        feature = F.get(F.col("_feat"), at)
        place = F.get(F.col("_bins"), feature)
        right = (
            F.when(feature < 0, F.lit(0))
            .when(place == MISSING, F.when(F.get(F.col("_miss"), at), 0).otherwise(1))
            .otherwise((place > F.get(F.col("_cut"), at)).cast("int"))
        )
        return at * 2 + 1 + right

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step)


def best_splits(sums: DataFrame, spec: PanelSpec, learner) -> DataFrame:
    """The best split of each node from its sums per feature and bin.

    The window sees the bins of one feature of one node, so its size has a fixed bound.
    """
    own = Window.partitionBy(spec.grain, "_node", "_feature")
    upto = own.orderBy(F.col("_bin") == MISSING, "_bin").rowsBetween(Window.unboundedPreceding, 0)
    is_missing = F.col("_bin") == MISSING
    parts = {}
    for c in ("_g", "_n"):
        parts |= {
            f"{c}_left": F.sum(c).over(upto).cast("double"),
            f"{c}_all": F.sum(c).over(own).cast("double"),
            f"{c}_lost": F.coalesce(F.sum(F.when(is_missing, F.col(c))).over(own), F.lit(0)).cast("double"),
        }

    def part_value(g: Column, n: Column) -> Column:
        return g * g / (n + learner.l2)

    def gain(g: Column, n: Column) -> Column:
        other = F.col("_n_all") - n
        fits = F.least(n, other) > learner.min_child - 0.5
        return F.when(fits, part_value(g, n) + part_value(F.col("_g_all") - g, other))

    missing_right = gain(F.col("_g_left"), F.col("_n_left"))
    missing_left = gain(F.col("_g_left") + F.col("_g_lost"), F.col("_n_left") + F.col("_n_lost"))
    before = part_value(F.col("_g_all"), F.col("_n_all"))
    scored = (
        sums.withColumns(parts)
        .filter(~is_missing)
        .withColumns({"_r": missing_right, "_l": missing_left})
        .withColumn("_score", (F.greatest("_r", "_l") - before).cast("float"))
        .filter(F.col("_score") > learner.min_gain)
    )
    goes_left = F.coalesce(F.col("_l") > F.col("_r"), F.col("_r").isNull())
    choice = F.struct(
        F.col("_feature").alias("_feat"),
        F.col("_bin").alias("_cut"),
        goes_left.alias("_miss"),
        F.col("_score").cast("double").alias("_gain"),
    )
    first = F.struct("_score", -F.col("_feature"), -F.col("_bin"))
    return scored.groupBy(spec.grain, "_node").agg(F.max_by(choice, first).alias("_best"))


def level_arrays(series: DataFrame, best: DataFrame, spec: PanelSpec, depth: int) -> DataFrame:
    """A row for each of ``series``, with an entry per node of the level."""
    found = best.groupBy(spec.grain).agg(
        F.map_from_entries(F.collect_list(F.struct("_node", "_best"))).alias("_found")
    )

    def entry(name: str, otherwise) -> Column:
        nodes = F.sequence(F.lit(0), F.lit(2**depth - 1))
        return F.transform(nodes, lambda i: F.coalesce(F.col("_found")[i][name], F.lit(otherwise)))

    arrays = [entry(c, o).alias(c) for c, o in TREE_COLUMNS.items()]
    return series.join(found, spec.grain, "left").select(spec.grain, *arrays)


def fit_boosted(df: DataFrame, spec: PanelSpec, learner, max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """Same trees as ``learner.fit`` on each series; one model row per series."""
    from tidecast.operators.scoring import evaluate, score

    features = spec.features(df)
    grain_field = df.schema[spec.grain]
    rows = spec.model_input(df).filter(F.col(spec.target).isNotNull())
    rows = rows.select(
        spec.grain,
        F.col(spec.target).cast("double").alias(spec.target),
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in features],
    )
    cuts = materialize(bin_cuts(rows, spec, features, learner.max_bin), "cuts")
    cells = materialize(cells_of(rows, cuts, spec, features), "cells")
    gradient = (F.col("_n") * F.col("_pred") - F.col("_y")).alias("_g")

    trees = []
    for t in range(learner.rounds):
        tree = None
        for d in range(learner.depth):
            placed = cells if tree is None else cells.join(tree, spec.grain)
            sums = (
                placed.select(
                    spec.grain,
                    (node_after(d) - (2**d - 1)).alias("_node"),
                    gradient,
                    "_n",
                    F.posexplode("_bins").alias("_feature", "_bin"),
                )
                .groupBy(spec.grain, "_node", "_feature", "_bin")
                .agg(F.sum("_g").alias("_g"), F.sum("_n").alias("_n"))
            )
            level = level_arrays(cuts.select(spec.grain), best_splits(sums, spec, learner), spec, d)
            if tree is None:
                tree = level
            else:
                both = [F.concat(tree[c], level[c]).alias(c) for c in TREE_COLUMNS]
                tree = tree.join(level, spec.grain).select(spec.grain, *both)
            tree = materialize(tree, "tree-level")
        leaf = (node_after(learner.depth) - (2**learner.depth - 1)).alias("_leaf")
        sums = (
            cells.join(tree, spec.grain)
            .select(spec.grain, leaf, gradient, "_n")
            .groupBy(spec.grain, "_leaf")
            .agg(F.sum("_g").alias("_g"), F.sum("_n").alias("_n"))
        )
        weight = (-learner.eta * F.col("_g") / (F.col("_n") + learner.l2)).cast("float")
        values = sums.groupBy(spec.grain).agg(
            F.map_from_entries(F.collect_list(F.struct("_leaf", weight))).alias("_leaves")
        )
        every = F.transform(
            F.sequence(F.lit(0), F.lit(2**learner.depth - 1)),
            lambda i: F.coalesce(F.col("_leaves")[i], F.lit(0.0).cast("float")),
        )
        tree = materialize(
            tree.join(values, spec.grain).withColumn("_value", every).drop("_leaves"), "tree"
        )
        trees.append(tree.withColumn("_round", F.lit(t)))
        moved = F.col("_pred") + F.get("_value", leaf)
        cells = cells.join(tree, spec.grain).select(
            spec.grain, "_bins", "_n", "_y", moved.alias("_pred")
        )
        if (t + 1) % TREES_PER_CHECKPOINT == 0:
            cells = materialize(cells, "cells")

    forest = trees[0]
    for tree in trees[1:]:
        forest = forest.unionByName(tree)
    importance_field = T.StructField("_importance", T.ArrayType(T.DoubleType()))
    blob_schema = T.StructType([grain_field, T.StructField("MODEL_BINARY", T.BinaryType()), importance_field])

    def pack(trees: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        trees = trees.sort_values("_round")
        feat, cut, miss, gain, value = (
            np.stack(trees[c].tolist()) for c in ("_feat", "_cut", "_miss", "_gain", "_value")
        )
        blob = learner.pack(edges["_base"].iloc[0], feat.astype(np.int16), cut, miss, value, edges["_cuts"].iloc[0])
        shares = learner.importances(feat, gain, len(features))
        return pd.DataFrame([[trees[spec.grain].iloc[0], blob, shares]], columns=blob_schema.names)

    packed = forest.groupBy(spec.grain).cogroup(cuts.groupBy(spec.grain)).applyInPandas(pack, blob_schema)
    packed = materialize(packed, "large-models")
    names = F.array(*[F.lit(c) for c in features]).cast("array<string>")
    scorable = packed.withColumns({"ALGORITHM": F.lit(learner.name), "FEATURE_COLS": names})
    quality = evaluate(score(df, scorable, spec, learners=(learner,), max_task_rows=max_task_rows), spec)
    metrics = F.struct(
        F.col("MAE").alias("TRAIN_MAE"),
        F.col("RMSE").alias("TRAIN_RMSE"),
        F.col("ROWS").alias("TRAIN_ROWS"),
        F.map_from_arrays(names, "_importance").alias("FEATURE_IMPORTANCES"),
    )
    failed = F.col("MODEL_BINARY").isNull()
    return (
        df.select(spec.grain)
        .distinct()
        .join(packed.join(quality, spec.grain), spec.grain, "left")
        .select(
            spec.grain,
            "MODEL_BINARY",
            F.when(~failed, metrics).alias("METRICS"),
            F.when(failed, "error").otherwise("ok").alias("STATUS"),
            F.when(failed, "no row with a target").alias("ERROR"),
        )
    )

"""Model catalog: which version of which series is active, and where its artifact lies.

The catalog is append-only. Plain Parquet has no update, and none is needed: the active
version of a series is its newest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.text import artifact_dir, path_name, path_part
from tidecast.spec import PanelSpec


def newest(df: DataFrame) -> Column:
    """Orders versions; names decide between equal times. A version without a time comes first."""
    names = [c for c in ("MODEL_VERSION", "RUN_ID") if c in df.columns]
    return F.struct(F.col("TRAINED_AT").isNull(), "TRAINED_AT", *names)


def entries(
    models: DataFrame, spec: PanelSpec, root: str, model_name: str | None = None, folder: str | None = None
) -> DataFrame:
    """Catalog rows of the models of one run; ``model_name`` keeps the versions of several models apart.

    STAGE_PATH is the folder of a series' artifact: below ``folder`` if it is given, else below the
    run's id in ``root``.
    """
    run = F.lit(folder) if folder else F.concat_ws("/", F.lit(root), "RUN_ID")
    return models.filter(F.col("MODEL_BINARY").isNotNull()).select(
        spec.grain,
        *([F.lit(model_name).alias("MODEL_NAME")] if model_name else []),
        "TRAINED_AT",
        "METRICS",
        "MODEL_VERSION",
        "RUN_ID",
        F.concat_ws("/", run, path_name(F.col(spec.grain))).alias("STAGE_PATH"),
    )


def with_active(catalog: DataFrame, spec: PanelSpec) -> DataFrame:
    """``catalog`` plus IS_ACTIVE: the newest version of a series, for each MODEL_NAME if there is one.

    It is found by aggregation, so a series with very many versions is combined before the shuffle.
    """
    keys = [c for c in (spec.grain, "MODEL_NAME") if c in catalog.columns]
    top = catalog.groupBy(*keys).agg(F.max(newest(catalog)).alias("_newest"))
    return (
        catalog.join(top, keys)
        .withColumn("IS_ACTIVE", newest(catalog) == F.col("_newest"))
        .drop("_newest")
    )


def latest_version(catalog: DataFrame) -> DataFrame:
    """One row: the most recently trained active version."""
    active = catalog.filter(F.col("IS_ACTIVE")) if "IS_ACTIVE" in catalog.columns else catalog
    return active.agg(F.max_by("MODEL_VERSION", newest(active)).alias("MODEL_VERSION"))


def artifact_paths(listing: DataFrame, path: str, artifact: str, grain: str, from_end: int) -> DataFrame:
    """Series and folder of every listed artifact; other files are left out.

    ``from_end`` tells which part of the folder names the series, 1 being the last.
    """
    folder = artifact_dir(F.col(path))
    return listing.filter(F.col(path).endswith(f"/{artifact}")).select(
        path_part(folder, from_end).alias(grain), folder.alias("STAGE_PATH")
    )


def attach_paths(metrics: DataFrame, paths: DataFrame, spec: PanelSpec) -> DataFrame:
    return metrics.join(paths, spec.grain)


def without_artifact(metrics: DataFrame, paths: DataFrame, spec: PanelSpec) -> DataFrame:
    """Catalog rows that ``attach_paths`` would lose."""
    return metrics.join(paths, spec.grain, "left_anti")


def rows_to_score(rows: DataFrame, catalog: DataFrame, spec: PanelSpec) -> DataFrame:
    """Test rows of series with an active model, with the model's path."""
    active = catalog.filter(F.col("IS_ACTIVE")).select(spec.grain, "STAGE_PATH")
    return rows.join(active, spec.grain)


def manifest(catalog: DataFrame, spec: PanelSpec, per_map: int = 10_000) -> DataFrame:
    """Series to path, as maps of about ``per_map`` entries each, so that no row holds all of them."""
    active = catalog.filter(F.col("IS_ACTIVE"))
    maps = active.count() // per_map + 1
    return (
        active.withColumn("PART", F.pmod(F.xxhash64(spec.grain), F.lit(maps)).cast("int"))
        .groupBy("PART")
        .agg(F.map_from_entries(F.collect_list(F.struct(spec.grain, "STAGE_PATH"))).alias("PATHS"))
    )


def single_value(df: DataFrame, by: str, column: str) -> DataFrame:
    """The one value of ``column`` of each ``by``; a group with several is an error."""
    low, high = F.min(column), F.max(column)
    many = F.raise_error(F.concat(F.lit(f"several values of {column} for one {by}: "), low.cast("string"), F.lit(", "), high.cast("string")))
    return df.groupBy(by).agg(F.when(low.eqNullSafe(high), low).otherwise(many).alias(column))

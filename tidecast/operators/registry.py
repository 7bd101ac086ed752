"""Model registry: named models, their versions, signatures and default version."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.spec import PanelSpec

SCHEMA = (
    "MODEL_NAME string, MODEL_VERSION string, RUN_ID string, "
    "SIGNATURE string, CREATED_AT timestamp_ntz"
)


def input_signature(df: DataFrame, spec: PanelSpec) -> T.StructType:
    """Roles give the types: text for the series, time for the time, float for the rest."""
    typed = {spec.grain: T.StringType(), spec.time: T.TimestampNTZType()}
    return T.StructType([
        T.StructField(c, typed.get(c, T.FloatType())) for c in df.columns if c != spec.target
    ])


def output_signature(spec: PanelSpec) -> T.StructType:
    return T.StructType([
        T.StructField(f"OUTPUT_{spec.grain}", T.StringType()),
        T.StructField(f"OUTPUT_{spec.time}", T.TimestampNTZType()),
        T.StructField(f"PRED_{spec.target}", T.FloatType()),
    ])


def conform(df: DataFrame, signature: T.StructType, *kept: str) -> DataFrame:
    """``df`` with the columns and types of a signature, and the columns ``kept`` as they are.

    A missing column is an error.
    """
    absent = [f.name for f in signature if f.name not in df.columns]
    if absent:
        raise ValueError(f"input lacks {absent}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in signature], *kept)


def entry(
    df: DataFrame, spec: PanelSpec, name: str, version: str, run_id: str, created_at: dt.datetime
) -> DataFrame:
    """The registry row of a version trained on the columns of ``df``."""
    row = (name, version, run_id, input_signature(df, spec).json(), created_at)
    return df.sparkSession.createDataFrame([row], SCHEMA)


def default_versions(registry: DataFrame) -> DataFrame:
    """The default of every model: the version registered last, be it anew or once more."""
    order = F.struct("CREATED_AT", "MODEL_VERSION")
    return registry.groupBy("MODEL_NAME").agg(
        F.max_by("MODEL_VERSION", order).alias("MODEL_VERSION"),
        F.max_by("RUN_ID", order).alias("RUN_ID"),
        F.max_by("SIGNATURE", order).alias("SIGNATURE"),
    )


def resolve(registry: DataFrame, name: str, version: str | None = None):
    """One registry row as (version, run id, signature); the default when no version is named."""
    found = registry.filter(F.col("MODEL_NAME") == name)
    if version is not None:
        found = found.filter(F.col("MODEL_VERSION") == version)
    row = default_versions(found).first()
    if row is None:
        raise ValueError(f"no model '{name}'" + (f" in version '{version}'" if version else ""))
    return row

"""Named tables in a namespace of the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidecast.spec import PanelSpec


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def feature_schema(spec: PanelSpec, num_features: int) -> T.StructType:
    features = [T.StructField(f"FEATURE_{i}", T.DoubleType()) for i in range(1, num_features + 1)]
    return T.StructType([
        T.StructField(spec.time, T.TimestampNTZType()),
        T.StructField(spec.grain, T.StringType()),
        *features,
        T.StructField(spec.target, T.DoubleType()),
    ])


def prediction_schema(spec: PanelSpec) -> T.StructType:
    return T.StructType([
        T.StructField(spec.grain, T.StringType()),
        T.StructField(spec.time, T.TimestampNTZType()),
        T.StructField(spec.target, T.DoubleType()),
        T.StructField("PREDICTION", T.DoubleType()),
    ])


class Namespace:
    """One database of the session catalog, with its tables under ``location`` if given."""

    def __init__(self, spark: SparkSession, name: str, location: str | None = None):
        self.spark, self.name = spark, name
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")

    def qualified(self, table: str) -> str:
        return f"{self.name}.{table}"

    def use(self) -> None:
        self.spark.catalog.setCurrentDatabase(self.name)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.qualified(table))

    def save(self, df: DataFrame, table: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> DataFrame:
        writer = df.write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.qualified(table))
        return self.table(table)

    def create(self, table: str, schema: T.StructType) -> DataFrame:
        """A typed empty table, unless it is there already."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.qualified(table)} ({columns}) USING parquet")
        return self.table(table)

    def snapshot(self, df: DataFrame, view: str) -> DataFrame:
        """A temporary table: the rows of ``df`` as they are now, for this session."""
        from tidecast.session import materialize

        kept = materialize(df, "snapshot")
        kept.createOrReplaceTempView(view)
        return kept

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.name) if not t.isTemporary)

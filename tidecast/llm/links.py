"""What links connect: the smallest member of each component, found in tasks and then by stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.session import materialize_observed

TASK_LINKS = 1_000_000  # contracted in one task


class Sets:
    """Union of rows; the first row of a set names it."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def names(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return self.up
            self.up = above

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.names()
        pairs = np.unique(np.stack([up[a], up[b]], 1)[up[a] != up[b]], axis=0)
        for x, y in pairs.tolist():
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            up[max(x, y)] = min(x, y)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links u, v from every node of a partition's links to the smallest it is connected with."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    links = pa.Table.from_batches(tables)
    names = sorted(set(links[0].to_pylist()) | set(links[1].to_pylist()))
    number = {name: k for k, name in enumerate(names)}
    sets = Sets(len(names))
    sets.unite(*(np.array([number[x] for x in column.to_pylist()]) for column in links.columns))
    up = sets.names()
    moved = np.flatnonzero(up != np.arange(len(up))).tolist()
    ends = [[names[i] for i in moved], [names[up[i]] for i in moved]]
    yield pa.RecordBatch.from_arrays([pa.array(e, pa.binary()) for e in ends], names=["u", "v"])


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node and root, the smallest node that its links lead to, for every linked node.

    First the links are contracted, so many in each task, to one per node. If that took several
    tasks, large and small stars take turns: a node passes its smallest neighbour on to its larger,
    then to its smaller neighbours. Hubs are summed up before any shuffle.
    """
    links, seen = materialize_observed(links, "links", n=F.count("*"))
    tasks = max(1, -(-(seen["n"] or 0) // task_links))
    check = {"n": F.count("*"), "sum": F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))}
    edges, seen = materialize_observed(links.repartition(tasks).mapInArrow(_forest, "u binary, v binary"), "forest", **check)
    state = None if tasks > 1 else (seen["n"], seen["sum"])
    while (seen["n"], seen["sum"]) != state:
        state = (seen["n"], seen["sum"])
        edges, seen = materialize_observed(_small_stars(_large_stars(edges)), "stars", **check)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _least(ways: DataFrame) -> DataFrame:
    return ways.groupBy("u").agg(F.min("v").alias("_v")).select(
        F.col("u").alias("_u"), F.least("u", "_v").alias("_least")
    )


def _large_stars(edges: DataFrame) -> DataFrame:
    ways = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    met = ways.join(_least(ways), F.col("u") == F.col("_u")).filter("v > u")
    return met.select(F.col("v").alias("u"), F.col("_least").alias("v")).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    met = edges.join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("_least").alias("v"))
    return met.unionAll(least.select(F.col("_u").alias("u"), F.col("_least").alias("v"))).filter("u != v").distinct()

"""Column roles of a panel: which column is the series, the time and the target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PanelSpec:
    """Roles of the columns of a multi-series table.

    ``tiebreak`` orders rows of one series that share a timestamp. With
    ``unique=True`` the caller states that (grain, time, tiebreak) is a key, so
    only those columns are read to order rows. Otherwise every further column
    joins the ordering, which makes rows that still tie exact copies.

    ``bucket`` is the calendar unit used for the first, coarse ordering step. A
    series should span some tens of buckets; see ``functions.calendar``.
    """

    grain: str = "PARTITION_ID"
    time: str = "TS"
    target: str = "TARGET"
    tiebreak: tuple[str, ...] = ()
    unique: bool = False
    bucket: str = "month"

    @property
    def roles(self) -> tuple[str, str, str]:
        return (self.grain, self.time, self.target)

    def features(self, df: DataFrame) -> list[str]:
        """Every column that has no role, in table order."""
        return [c for c in df.columns if c not in self.roles]

    def order_columns(self, df: DataFrame) -> list[str]:
        """Columns that order the rows of one series."""
        named = [self.time, *self.tiebreak]
        if self.unique:
            return named
        return named + [c for c in df.columns if c != self.grain and c not in named]

    def order_key(self, df: DataFrame) -> Column:
        """One comparable struct per row; rows without a time come last."""
        cols = self.order_columns(df)
        return F.struct(F.col(self.time).isNull().alias("no_time"), *[F.col(c) for c in cols])

    def model_input(self, df: DataFrame) -> DataFrame:
        """Role columns plus features in float32, as the learners take them."""
        feats = [F.col(c).cast("float").alias(c) for c in self.features(df)]
        return df.select(
            self.grain, self.time, F.col(self.target).cast("float").alias(self.target), *feats
        )

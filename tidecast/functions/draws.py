"""Random draws that depend only on a key.

``rand(seed)`` changes with the partitioning and cannot be repeated elsewhere. A hash of
the row's key gives the same number on every engine, in every partition, after any retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit(key: Column) -> Column:
    """Uniform in (0, 1)."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return (head + F.lit(0.5)) / F.lit(4294967296.0)


def uniform(key: Column, low: float, high: float) -> Column:
    return F.lit(low) + F.lit(high - low) * unit(key)


def normal(key: Column, mean: float, sd: float) -> Column:
    """Two hashes turned into one normal draw."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(unit(F.concat(key, F.lit("/r")))))
    angle = F.lit(2.0) * F.pi() * unit(F.concat(key, F.lit("/a")))
    return F.lit(mean) + F.lit(sd) * radius * F.cos(angle)

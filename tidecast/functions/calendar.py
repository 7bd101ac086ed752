"""Calendar features, timestamp spines and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spine steps.
TIMESTEPS = ("second", "minute", "hour", "day", "week", "month")

# Rows without a time are ordered behind every real bucket.
NO_TIME_BUCKET = 2**62


def day_of_year_ratio(time: Column) -> Column:
    return F.dayofyear(time) / F.lit(365.0)


def weekday_ratio(time: Column) -> Column:
    """Monday is 0 and Sunday is 1."""
    return F.weekday(time) / F.lit(6.0)


def seasonal(time: Column) -> Column:
    """Yearly wave around 1 with an amplitude of 0.2."""
    return F.lit(1.0) + F.lit(0.2) * F.sin(F.lit(2.0) * F.pi() * F.dayofyear(time) / F.lit(365.0))


def weekday_effect(time: Column) -> Column:
    """1.1 on Friday and Saturday, else 1."""
    return F.when(F.weekday(time).isin(4, 5), F.lit(1.1)).otherwise(F.lit(1.0))


def check_timestep(step: str) -> str:
    if step not in TIMESTEPS:
        raise ValueError(f"cannot step by '{step}', only by {', '.join(TIMESTEPS)}")
    return step


def step_from(origin: Column, step: str, n: Column) -> Column:
    """``origin`` moved by ``n`` steps; months count from the origin and clamp to month end."""
    return F.timestamp_add(check_timestep(step).upper(), n, origin)


def _is_zoned(time: Column) -> Column:
    return F.typeof(time) == "timestamp"


def time_bucket(time: Column, unit: str) -> Column:
    """A whole number that grows with time, one value per calendar unit."""
    day = F.unix_date(F.to_date(time)).cast("long")
    # Hours of a zoned time repeat when clocks go back, so those count from the epoch.
    minute = F.when(
        _is_zoned(time), F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(60_000_000)).cast("long")
    ).otherwise((day * 24 + F.hour(time)) * 60 + F.minute(time))
    buckets = {
        "year": F.year(time).cast("long"),
        "month": F.year(time).cast("long") * 12 + F.month(time),
        "day": day,
        "hour": F.floor(minute / F.lit(60)).cast("long"),
        "minute": minute,
    }
    if unit not in buckets:
        raise ValueError(f"unknown bucket '{unit}', expected one of {list(buckets)}")
    return F.coalesce(buckets[unit], F.lit(NO_TIME_BUCKET))


def micros_between(start: Column, end: Column) -> Column:
    """Elapsed microseconds, whatever the time zone of the session."""
    elapsed = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    day, hour, minute, second = (
        F.extract(F.lit(part), elapsed) for part in ("DAY", "HOUR", "MINUTE", "SECOND")
    )
    whole = ((day.cast("long") * 24 + hour) * 60 + minute) * 60
    local = whole * 1_000_000 + (second * 1_000_000).cast("long")
    exact = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.when(_is_zoned(start) & _is_zoned(end), exact).otherwise(local)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction."""
    return micros_between(start, end) / F.lit(1e6)


def parse_time(value: Column, pattern: str, bad: str = "null") -> Column:
    """Text as a time without a zone; text that does not match is null, or an error if ``bad`` is 'error'."""
    if bad not in ("null", "error"):
        raise ValueError("bad must be 'null' or 'error'")
    parse = F.try_to_timestamp if bad == "null" else F.to_timestamp
    wanted = F.lit(pattern) if bad == "null" else pattern
    return parse(value, wanted).cast("timestamp_ntz")

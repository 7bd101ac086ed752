"""Names of versions and runs, artifact paths, log lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name formats of versions and runs.
VERSION_FORMAT = "'v'yyyyMMdd_HHmm"
INFERENCE_FORMAT = "'inference_'yyyyMMdd_HHmm"
TRAINING_PREFIX = "training_"
RUN_ID_PATTERN = r"RUN_ID=(.+)"


def model_version(at: Column) -> Column:
    return F.date_format(at, VERSION_FORMAT)


def training_run_id(version: Column) -> Column:
    return F.concat(F.lit(TRAINING_PREFIX), version)


def inference_run_id(at: Column) -> Column:
    return F.date_format(at, INFERENCE_FORMAT)


def version_of(at: dt.datetime) -> str:
    return at.strftime("v%Y%m%d_%H%M")


def run_ids_of(at: dt.datetime) -> tuple[str, str]:
    """Training and inference run ids of a run started at ``at``."""
    return TRAINING_PREFIX + version_of(at), at.strftime("inference_%Y%m%d_%H%M")


def run_id_in(log: Column) -> Column:
    """The run id a job printed, or an empty string."""
    return F.trim(F.regexp_extract(log, RUN_ID_PATTERN, 1))


def series_id(prefix: str, number: Column, digits: int = 4) -> Column:
    """``P0007``; longer numbers keep all their digits."""
    return F.format_string(f"{prefix}%0{digits}d", number)


def path_name(name: Column) -> Column:
    """A name as one part of a path: letters, digits, ``-``, ``_`` and inner dots stay, all else is percent-encoded."""
    coded = F.regexp_replace(F.regexp_replace(F.url_encode(name.cast("string")), r"\+", "%20"), r"\*", "%2A")
    return F.when(coded == "", "%").otherwise(F.regexp_replace(coded, r"^\.", "%2E"))


def artifact_dir(path: Column) -> Column:
    """The path without its last part."""
    return F.regexp_replace(path, r"/[^/]*$", "")


def path_part(path: Column, from_end: int) -> Column:
    """The n-th part of a path, counted from its end, 1 being the last."""
    return F.element_at(F.split(path, "/"), -from_end)


def without_last_name(dotted: Column) -> Column:
    """``db.schema`` of ``db.schema.stage``."""
    return F.regexp_replace(dotted, r"\.[^.]*$", "")

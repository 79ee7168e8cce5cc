"""Load-quality reports over parsed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.session import stage_table

# Fixed values of parse_status.
PARSED = 1
FAILED = 0  # log and rating lines
HEADER = 0  # record lines
INVALID = -1  # record lines


def status_counts(parsed: DataFrame) -> DataFrame:
    """Lines per ``parse_status``."""
    return parsed.groupBy("parse_status").agg(F.count("*").alias("n"))


def _counts(**statuses: int) -> list[Column]:
    return [F.count("*").alias("lines"), *[F.count_if(F.col("parse_status") == status).alias(name) for name, status in statuses.items()]]


_LOG = {"parsed": PARSED, "failed": FAILED}
_RECORDS = {"parsed": PARSED, "header": HEADER, "invalid": INVALID}


def log_quality(parsed: DataFrame) -> DataFrame:
    """One row: lines read, parsed and failed."""
    return parsed.agg(*_counts(**_LOG))


def record_quality(parsed: DataFrame) -> DataFrame:
    """One row: lines read, parsed, headers and invalid."""
    return parsed.agg(*_counts(**_RECORDS))


def observed(parsed: DataFrame, records: bool = False) -> tuple[DataFrame, Observation]:
    """The same rows, and the counts of :func:`log_quality` (or :func:`record_quality`) once an action has read them all."""
    observation = Observation("load quality")
    return parsed.observe(observation, *_counts(**(_RECORDS if records else _LOG))), observation


def kept_with_quality(parsed: DataFrame, records: bool = False) -> tuple[DataFrame, DataFrame]:
    """The parsed rows, staged, and the one-row quality report of all lines, from one pass over the lines.

    The lines are counted on their way to the filter. Without any line all counts are 0.
    """
    seen, observation = observed(parsed, records)
    kept = stage_table(seen.filter(F.col("parse_status") == PARSED))
    names = ["lines", *(_RECORDS if records else _LOG)]
    counts = [int(observation.get.get(name, 0)) for name in names]
    return kept, parsed.sparkSession.createDataFrame([counts], ", ".join(f"{name} long" for name in names))


def status_sample(parsed: DataFrame, status: int, n: int, *order: str) -> DataFrame:
    """The first ``n`` lines with a status, in a stated order."""
    return parsed.filter(F.col("parse_status") == status).orderBy(*order).limit(n)

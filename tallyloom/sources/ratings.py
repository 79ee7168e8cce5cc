"""Ratings and items in ``::``-separated lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.quality import FAILED, PARSED

SEPARATOR = "::"


def _with_status(lines: DataFrame, values: dict[str, Column]) -> DataFrame:
    usable = F.lit(True)
    for value in values.values():
        usable = usable & value.isNotNull()
    return lines.select(
        *lines.columns,
        F.when(usable, F.lit(PARSED)).otherwise(F.lit(FAILED)).alias("parse_status"),
        *[value.alias(name) for name, value in values.items()],
    )


def parse_ratings(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``parse_status``, ``user_id``, ``item_id`` and ``rating``; the time is dropped."""
    field = F.split(F.col(line), SEPARATOR)
    return _with_status(
        lines,
        {
            "user_id": F.get(field, F.lit(0)).try_cast("bigint"),
            "item_id": F.get(field, F.lit(1)).try_cast("bigint"),
            "rating": F.get(field, F.lit(2)).try_cast("double"),
        },
    )


def parse_items(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``parse_status``, ``item_id`` and ``title``; the genres are dropped."""
    field = F.split(F.col(line), SEPARATOR)
    return _with_status(
        lines,
        {"item_id": F.get(field, F.lit(0)).try_cast("bigint"), "title": F.get(field, F.lit(1))},
    )

"""Quoted product records and gold-standard mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.fields import has_fields, with_fields
from tallyloom.sources.quality import HEADER, INVALID, PARSED

# The line patterns and the first field of each header.
# (?d): a dot stops only at a line feed.
PRODUCT_PATTERN = '(?d)^(.+),"(.+)",(.*),(.*),(.*)'
PRODUCT_HEADER = '"id"'
GOLD_PATTERN = "(?d)^(.+),(.+)"
GOLD_HEADER = '"idAmazon"'


def _unquoted(text: Column) -> Column:
    return F.translate(text, '"', "")


def _status(fields: Column, groups: int, header: str) -> Column:
    return (
        F.when(~has_fields(fields, groups), F.lit(INVALID))
        .when(F.get(fields, 0) == header, F.lit(HEADER))
        .otherwise(F.lit(PARSED))
    )


def parse_products(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``parse_status``, ``id`` and ``text`` to lines of product records.

    The text is the title, description and manufacturer; their own quotes stay.
    The price is dropped. Headers are known by content, not by position.
    """
    fields = F.col("_fields")
    split = with_fields(lines, line, PRODUCT_PATTERN, 4)
    status = _status(fields, 4, PRODUCT_HEADER)
    return split.select(
        *lines.columns,
        status.alias("parse_status"),
        F.when(status == PARSED, _unquoted(F.get(fields, 0))).alias("id"),
        F.when(status == PARSED, F.concat_ws(" ", F.get(fields, 1), F.get(fields, 2), F.get(fields, 3))).alias("text"),
    )


def parse_gold(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``parse_status``, ``a_id`` and ``b_id`` to lines of a gold mapping."""
    fields = F.col("_fields")
    split = with_fields(lines, line, GOLD_PATTERN, 2)
    status = _status(fields, 2, GOLD_HEADER)
    return split.select(
        *lines.columns,
        status.alias("parse_status"),
        F.when(status == PARSED, _unquoted(F.get(fields, 0))).alias("a_id"),
        F.when(status == PARSED, _unquoted(F.get(fields, 1))).alias("b_id"),
    )

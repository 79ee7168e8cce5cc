"""Splitting a line into the groups of a pattern with one match per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BREAK = "\n"


def with_fields(lines: DataFrame, line: str, pattern: str, groups: int, name: str = "_fields") -> DataFrame:
    """Add an array of the first ``groups`` groups, or an array of another size without a match.

    The whole match is replaced by its groups, one per line, in one pass; calling
    ``regexp_extract`` per field would run the pattern once per field. A line of
    text holds no line break, so the break cannot be part of a field.

    The array is added by ``explode`` because filters on the fields are not moved
    below it; moved below a projection, they would run the pattern once per use.
    """
    replaced = F.regexp_replace(F.col(line), "(?s)" + pattern + ".*", _BREAK.join(f"${i}" for i in range(1, groups + 1)))
    # A value that does hold a line break is no line and never taken for a match.
    fields = F.when(~F.contains(F.col(line), F.lit(_BREAK)), F.split(replaced, _BREAK)).otherwise(F.array().cast("array<string>"))
    return lines.select(*lines.columns, F.explode_outer(F.array(fields)).alias(name))


def has_fields(fields: Column, groups: int) -> Column:
    return F.size(fields) == groups

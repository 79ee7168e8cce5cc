"""Web-server access logs in the Common Log Format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.fields import has_fields, with_fields
from tallyloom.sources.quality import FAILED, PARSED

# The two line patterns.
STRICT_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
REPAIRED_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'

FIELDS = 9


def log_timestamp(text: Column) -> Column:
    """``dd/Mon/yyyy:HH:mm:ss`` as a timestamp without zone; NULL for an impossible date.

    The zone offset is ignored, so the value never depends on the session zone: the
    day is read at noon, which every zone has, and the time of day is added as text.
    """
    day = F.try_to_timestamp(F.concat(F.substring(text, 1, 11), F.lit(":12")), F.lit("dd/MMM/yyyy:HH")).cast("date")
    return F.concat(day.cast("string"), F.lit(" "), F.substring(text, 13, 8)).try_cast("timestamp_ntz")


def parse_access_log(lines: DataFrame, line: str = "line", pattern: str = REPAIRED_PATTERN) -> DataFrame:
    """Add ``parse_status`` and the nine log fields to a table of lines.

    A line that does not match, or whose date, code or size is unusable, is
    marked failed and has NULL fields; it never stops the job. A size of ``-``
    counts as zero.
    """
    text = [F.get("_fields", F.lit(index)) for index in range(FIELDS)]
    values = {
        "host": text[0],
        "client_identd": text[1],
        "user_id": text[2],
        "date_time": log_timestamp(text[3]),
        "method": text[4],
        "endpoint": text[5],
        "protocol": text[6],
        "response_code": text[7].try_cast("int"),
        "content_size": F.when(text[8] == "-", F.lit("0")).otherwise(text[8]).try_cast("long"),
    }
    record = F.struct(*[value.alias(name) for name, value in values.items()])
    # Exploded for the same reason as the fields: later filters reuse the converted values.
    typed = with_fields(lines, line, pattern, FIELDS).select(
        *lines.columns,
        F.explode_outer(F.array(F.when(has_fields(F.col("_fields"), FIELDS), record))).alias("_record"),
    )
    usable = F.col("_record.date_time").isNotNull() & F.col("_record.content_size").isNotNull()
    return typed.select(
        *lines.columns,
        F.when(usable, F.lit(PARSED)).otherwise(F.lit(FAILED)).alias("parse_status"),
        *[F.when(usable, F.col(f"_record.{name}")).alias(name) for name in values],
    )


def access_records(lines: DataFrame, line: str = "line", pattern: str = REPAIRED_PATTERN) -> DataFrame:
    """Only the parsed records, without the raw line."""
    parsed = parse_access_log(lines, line, pattern)
    return parsed.filter(F.col("parse_status") == PARSED).drop(line, "parse_status")

"""All access-log reports from one pass over the lines.

Each line is parsed once and counted under several groupings at a time (GROUPING SETS); tasks combine their own rows
before anything is shuffled. What comes out is one row per response code, host, endpoint, hour, and day and host,
which is staged. Every report is a small query on these rows, and gives what its function in
:mod:`tallyloom.plans.access` gives. Hosts are counted exactly: a host is one row, and so is a host's day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numbers import int_quotient
from tallyloom.operators.counting import share_of_total
from tallyloom.operators.ranking import top_by
from tallyloom.plans.access import NOT_FOUND, OK
from tallyloom.session import stage_table
from tallyloom.sources.access_log import REPAIRED_PATTERN, parse_access_log
from tallyloom.sources.quality import PARSED

_KEYS = ("response_code", "host", "endpoint", "day", "hour")
#: The groupings; the empty one has the totals.
GROUPINGS = {"total": (), "code": ("response_code",), "host": ("host",), "endpoint": ("endpoint",), "day_host": ("day", "host"), "hour": ("hour",)}


def grouped_counts(lines: DataFrame, line: str = "line", pattern: str = REPAIRED_PATTERN) -> DataFrame:
    """One row per group of every grouping: ``grouping``, the keys, and lines, records, errors, missing pages and sizes."""
    parsed = parse_access_log(lines, line, pattern).select(
        "parse_status", "response_code", "host", "endpoint", F.dayofmonth("date_time").alias("day"), F.hour("date_time").alias("hour"), "content_size"
    )
    record = F.col("parse_status") == PARSED
    counted = parsed.groupingSets([list(keys) for keys in GROUPINGS.values()], *_KEYS).agg(
        # A bit of the number is set where a key is not grouped by, the first key's is the highest.
        F.grouping_id(*_KEYS).alias("_id"),
        F.count("*").alias("lines"),
        F.count_if(record).alias("n"),
        F.count_if(F.col("response_code") != OK).alias("not_ok"),
        F.count_if(F.col("response_code") == NOT_FOUND).alias("missing"),
        F.sum("content_size").alias("size_sum"),
        F.min("content_size").alias("size_min"),
        F.max("content_size").alias("size_max"),
    )
    name = F.lit(None).cast("string")
    for grouping, keys in GROUPINGS.items():
        number = sum(1 << (len(_KEYS) - 1 - place) for place, key in enumerate(_KEYS) if key not in keys)
        name = F.when(F.col("_id") == number, F.lit(grouping)).otherwise(name)
    return counted.withColumn("grouping", name).drop("_id").filter((F.col("grouping") == "total") | (F.col("n") > 0))


class AccessSummary:
    """The reports of a log; lines that are no records count in :meth:`quality` only."""

    def __init__(self, lines: DataFrame, line: str = "line", pattern: str = REPAIRED_PATTERN):
        self.counts = stage_table(grouped_counts(lines, line, pattern))

    def _of(self, grouping: str) -> DataFrame:
        return self.counts.filter(F.col("grouping") == grouping)

    def _total(self) -> DataFrame:
        """One row, of zeros for a log without lines."""
        sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("lines", "n", "missing")]
        return self._of("total").agg(*sums, F.sum("size_sum").alias("size_sum"), F.min("size_min").alias("size_min"), F.max("size_max").alias("size_max"))

    def _missing(self, grouping: str, key: str) -> DataFrame:
        return self._of(grouping).filter("missing > 0").select(key, F.col("missing").alias("n"))

    def _days(self, measure: str) -> DataFrame:
        return self._of("day_host").groupBy("day").agg(F.sum(measure).alias("n"), F.count("*").alias("hosts"))

    def quality(self) -> DataFrame:
        return self._total().select("lines", F.col("n").alias("parsed"), (F.col("lines") - F.col("n")).alias("failed"))

    def content_size_stats(self) -> DataFrame:
        return self._total().select(int_quotient(F.col("size_sum"), F.col("n")).alias("average"), F.col("size_min").alias("minimum"), F.col("size_max").alias("maximum"))

    def response_code_counts(self) -> DataFrame:
        return self._of("code").select("response_code", "n")

    def response_code_share(self) -> DataFrame:
        return share_of_total(self.response_code_counts())

    def frequent_hosts(self, more_than: int = 10) -> DataFrame:
        return self._of("host").filter(F.col("n") > more_than).select("host", "n")

    def endpoint_counts(self) -> DataFrame:
        return self._of("endpoint").select("endpoint", "n")

    def top_endpoints(self, n: int = 10) -> DataFrame:
        return top_by(self.endpoint_counts(), n, "n", "endpoint")

    def top_error_endpoints(self, n: int = 10) -> DataFrame:
        failed = self._of("endpoint").filter("not_ok > 0").select("endpoint", F.col("not_ok").alias("n"))
        return top_by(failed, n, "n", "endpoint")

    def unique_hosts(self) -> DataFrame:
        return self._of("host").agg(F.count("*").alias("hosts"))

    def daily_unique_hosts(self) -> DataFrame:
        return self._days("n").select("day", "hosts").orderBy("day")

    def daily_requests_per_host(self) -> DataFrame:
        return self._days("n").select("day", int_quotient(F.col("n"), F.col("hosts")).alias("requests_per_host")).orderBy("day")

    def not_found_count(self) -> DataFrame:
        return self._total().select(F.col("missing").alias("n"))

    def not_found_endpoints(self, n: int = 40) -> DataFrame:
        return self._missing("endpoint", "endpoint").select("endpoint").orderBy("endpoint").limit(n)

    def top_not_found_endpoints(self, n: int = 20) -> DataFrame:
        return top_by(self._missing("endpoint", "endpoint"), n, "n", "endpoint")

    def top_not_found_hosts(self, n: int = 25) -> DataFrame:
        return top_by(self._missing("host", "host"), n, "n", "host")

    def daily_not_found(self) -> DataFrame:
        return self._days("missing").filter("n > 0").select("day", "n").orderBy("day")

    def top_not_found_days(self, n: int = 5) -> DataFrame:
        return top_by(self.daily_not_found(), n, "n", "day")

    def hourly_not_found(self) -> DataFrame:
        return self._missing("hour", "hour").orderBy("hour")

"""Reports over parsed access-log records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.counting import count_by, distinct_count, distinct_count_by, rows_per_distinct, share_of_total
from tallyloom.operators.ranking import top_by

OK = 200
NOT_FOUND = 404


def _day() -> Column:
    return F.dayofmonth("date_time").alias("day")


def response_code_share(logs: DataFrame) -> DataFrame:
    return share_of_total(count_by(logs, "response_code"))


def frequent_hosts(logs: DataFrame, more_than: int = 10) -> DataFrame:
    return count_by(logs, "host").filter(F.col("n") > more_than)


def top_endpoints(logs: DataFrame, n: int = 10) -> DataFrame:
    return top_by(count_by(logs, "endpoint"), n, "n", "endpoint")


def not_ok(logs: DataFrame) -> DataFrame:
    """Requests with any code other than 200, so redirects and not-modified answers too."""
    return logs.filter(F.col("response_code") != OK)


def not_found(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("response_code") == NOT_FOUND)


def unique_hosts(logs: DataFrame) -> DataFrame:
    return distinct_count(logs, "host", "hosts")


def daily_unique_hosts(logs: DataFrame) -> DataFrame:
    """Distinct hosts per day of the month; days without requests are not filled in."""
    return distinct_count_by(logs, _day(), "host", "hosts").orderBy("day")


def daily_requests_per_host(logs: DataFrame) -> DataFrame:
    return rows_per_distinct(logs, _day(), "host", "requests_per_host").orderBy("day")


def daily_not_found(logs: DataFrame) -> DataFrame:
    return count_by(not_found(logs), _day()).orderBy("day")


def top_not_found_days(logs: DataFrame, n: int = 5) -> DataFrame:
    return top_by(count_by(not_found(logs), _day()), n, "n", "day")


def hourly_not_found(logs: DataFrame) -> DataFrame:
    return count_by(not_found(logs), F.hour("date_time").alias("hour")).orderBy("hour")


def not_found_endpoints(logs: DataFrame, n: int = 40) -> DataFrame:
    """The first ``n`` distinct endpoints that were not found."""
    return not_found(logs).select("endpoint").distinct().orderBy("endpoint").limit(n)

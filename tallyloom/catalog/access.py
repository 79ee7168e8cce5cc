"""Access-log parsing, load quality and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import SQL, query
from tallyloom.catalog.tables import access_log_lines
from tallyloom.operators.counting import count_by, count_rows, integer_stats
from tallyloom.operators.ranking import top_by
from tallyloom.plans import access
from tallyloom.plans.access_summary import AccessSummary
from tallyloom.session import own_folder, stage_table
from tallyloom.sinks.versions import read_table, write_table
from tallyloom.sources.access_log import REPAIRED_PATTERN, STRICT_PATTERN, access_records, parse_access_log
from tallyloom.sources.quality import FAILED, kept_with_quality, log_quality, status_sample

# The same records from the columns of the events, without any parsing.
RECORDS = """
    SELECT event_id, 'host-' || user_id || '.example.net' AS host, date_trunc('second', ts) AS date_time,
           '/' || event_type || '/' || regexp_extract(props, '([0-9]+)', 1) AS endpoint,
           CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 302 WHEN 'click' THEN 304 ELSE 200 END
             AS response_code,
           CASE WHEN event_type = 'click' THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS content_size
    FROM events WHERE event_id % 97 <> 0
"""
LOG = f"WITH log AS ({RECORDS}) "


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_records(access_log_lines(spark, sf_dir))


@query(
    "clf_parse",
    LOG
    + """
    SELECT e.event_id, CASE WHEN log.event_id IS NULL THEN 0 ELSE 1 END AS parse_status, host,
           CASE WHEN log.event_id IS NOT NULL THEN '-' END AS client_identd,
           CASE WHEN log.event_id IS NOT NULL THEN '-' END AS log_user,
           date_time, CASE WHEN log.event_id IS NOT NULL THEN 'GET' END AS method, endpoint,
           CASE WHEN log.event_id IS NOT NULL THEN 'HTTP/1.0' END AS protocol,
           CAST(response_code AS INTEGER) AS response_code, content_size
    FROM events e LEFT JOIN log ON log.event_id = e.event_id
    """,
)
def clf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_access_log(access_log_lines(spark, sf_dir)).drop("line").withColumnRenamed("user_id", "log_user")


@query(
    "parse_quality",
    """
    SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 97 <> 0) AS parsed,
           count(*) FILTER (WHERE event_id % 97 = 0) AS failed
    FROM events
    """,
)
def parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_quality(parse_access_log(access_log_lines(spark, sf_dir)))


@query(
    "parse_failures_sample",
    """
    SELECT event_id,
           'host-' || user_id || '.example.net - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' 0000] "GET /'
           || event_type || '/' || regexp_extract(props, '([0-9]+)', 1) || ' HTTP/1.0'
           || CASE WHEN event_id % 89 = 0 THEN ' ' ELSE '' END || '" '
           || CASE event_type WHEN 'error' THEN '404' WHEN 'signup' THEN '302' WHEN 'click' THEN '304' ELSE '200' END
           || ' ' || CASE WHEN event_type = 'click' THEN '-' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END
             AS line
    FROM events WHERE event_id % 97 = 0 ORDER BY event_id LIMIT 20
    """,
)
def parse_failures_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_access_log(access_log_lines(spark, sf_dir))
    return status_sample(parsed, FAILED, 20, "event_id").select("event_id", "line")


@query(
    "clf_pattern_compare",
    """
    SELECT 'strict' AS pattern, count(*) AS lines,
           count(*) FILTER (WHERE event_id % 97 <> 0 AND event_id % 89 <> 0) AS parsed,
           count(*) FILTER (WHERE event_id % 97 = 0 OR event_id % 89 = 0) AS failed
    FROM events
    UNION ALL
    SELECT 'repaired', count(*), count(*) FILTER (WHERE event_id % 97 <> 0), count(*) FILTER (WHERE event_id % 97 = 0)
    FROM events
    """,
)
def clf_pattern_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = access_log_lines(spark, sf_dir)

    def quality(name: str, pattern: str) -> DataFrame:
        report = log_quality(parse_access_log(lines, pattern=pattern))
        return report.select(F.lit(name).alias("pattern"), "lines", "parsed", "failed")

    return quality("strict", STRICT_PATTERN).unionByName(quality("repaired", REPAIRED_PATTERN))


@query(
    "content_size_stats",
    LOG
    + """
    SELECT CAST(sum(content_size) AS BIGINT) // count(*) AS average, min(content_size) AS minimum,
           max(content_size) AS maximum
    FROM log
    """,
)
def content_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integer_stats(logs(spark, sf_dir), "content_size")


@query(
    "written_records",
    LOG
    + """
    SELECT event_id, host, date_time, endpoint, CAST(response_code AS INTEGER) AS response_code, content_size,
           CAST(day(date_time) AS INTEGER) AS day
    FROM log
    """,
)
def written_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as read back from a table that was written in two batches, one of them twice."""
    records = stage_table(
        logs(spark, sf_dir).select("event_id", "host", "date_time", "endpoint", "response_code", "content_size", F.dayofmonth("date_time").alias("day"))
    )
    path, early = own_folder(spark, "records"), F.col("day") <= 15
    for batch, part in (("early", early), ("late", ~early), ("early", early)):
        write_table(records.filter(part), path, ["day"], batch)
    return read_table(spark, path)


@query("response_code_counts", LOG + "SELECT response_code, count(*) AS n FROM log GROUP BY 1")
def response_code_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(logs(spark, sf_dir), "response_code")


@query(
    "response_code_share",
    LOG
    + """
    SELECT response_code, count(*) AS n, round(count(*) / (SELECT count(*) FROM log), 6) AS share
    FROM log GROUP BY 1
    """,
)
def response_code_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.response_code_share(logs(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query("frequent_hosts", LOG + "SELECT host, count(*) AS n FROM log GROUP BY 1 HAVING count(*) > 10")
def frequent_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.frequent_hosts(logs(spark, sf_dir))


@query(
    "any_n_hosts",
    LOG + "SELECT host, count(*) AS n FROM log GROUP BY 1 HAVING count(*) > 10 ORDER BY host LIMIT 20",
)
def any_n_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.frequent_hosts(logs(spark, sf_dir)).orderBy("host").limit(20)


@query("endpoint_counts", LOG + "SELECT endpoint, count(*) AS n FROM log GROUP BY 1")
def endpoint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(logs(spark, sf_dir), "endpoint")


@query("top_endpoints", LOG + "SELECT endpoint, count(*) AS n FROM log GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10")
def top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.top_endpoints(logs(spark, sf_dir))


@query(
    "top_error_endpoints",
    LOG
    + """
    SELECT endpoint, count(*) AS n FROM log WHERE response_code <> 200
    GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 10
    """,
)
def top_error_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.top_endpoints(access.not_ok(logs(spark, sf_dir)))


@query("unique_hosts", LOG + "SELECT count(DISTINCT host) AS hosts FROM log")
def unique_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.unique_hosts(logs(spark, sf_dir))


@query(
    "daily_unique_hosts",
    LOG + "SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS hosts FROM log GROUP BY 1 ORDER BY 1",
)
def daily_unique_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.daily_unique_hosts(logs(spark, sf_dir))


@query(
    "daily_requests_per_host",
    LOG
    + """
    SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) // count(DISTINCT host) AS requests_per_host
    FROM log GROUP BY 1 ORDER BY 1
    """,
)
def daily_requests_per_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.daily_requests_per_host(logs(spark, sf_dir))


NOT_FOUND = LOG + ", missing AS (SELECT * FROM log WHERE response_code = 404) "


@query("not_found_count", NOT_FOUND + "SELECT count(*) AS n FROM missing")
def not_found_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(access.not_found(logs(spark, sf_dir)))


@query("distinct_404_endpoints", NOT_FOUND + "SELECT DISTINCT endpoint FROM missing ORDER BY endpoint LIMIT 40")
def distinct_404_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.not_found_endpoints(logs(spark, sf_dir))


@query(
    "top_404_endpoints",
    NOT_FOUND + "SELECT endpoint, count(*) AS n FROM missing GROUP BY 1 ORDER BY n DESC, endpoint LIMIT 20",
)
def top_404_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.top_endpoints(access.not_found(logs(spark, sf_dir)), 20)


@query("top_404_hosts", NOT_FOUND + "SELECT host, count(*) AS n FROM missing GROUP BY 1 ORDER BY n DESC, host LIMIT 25")
def top_404_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_by(count_by(access.not_found(logs(spark, sf_dir)), "host"), 25, "n", "host")


BY_DAY = "SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n FROM missing GROUP BY 1 "


@query("daily_404", NOT_FOUND + BY_DAY + "ORDER BY 1")
def daily_404(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.daily_not_found(logs(spark, sf_dir))


@query("top_404_days", NOT_FOUND + BY_DAY + "ORDER BY n DESC, 1 LIMIT 5")
def top_404_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.top_not_found_days(logs(spark, sf_dir))


@query(
    "hourly_404",
    NOT_FOUND + "SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS n FROM missing GROUP BY 1 ORDER BY 1",
)
def hourly_404(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access.hourly_not_found(logs(spark, sf_dir))


def _report_row(name: str, key: str, n: str, value: str = "CAST(NULL AS DOUBLE)") -> str:
    return f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS key, CAST({n} AS BIGINT) AS n, {value} AS value FROM ({SQL[name]})"


_KEYED = {
    "response_code_counts": "response_code", "frequent_hosts": "host", "any_n_hosts": "host", "endpoint_counts": "endpoint", "top_endpoints": "endpoint",
    "top_error_endpoints": "endpoint", "top_404_endpoints": "endpoint", "top_404_hosts": "host", "daily_404": "day", "top_404_days": "day", "hourly_404": "hour",
}


@query(
    "access_report",
    " UNION ALL ".join(
        [_report_row(name, key, "n") for name, key in _KEYED.items()]
        + [_report_row("content_size_stats", f"'{part}'", part) for part in ("average", "minimum", "maximum")]
        + [_report_row("parse_quality", f"'{part}'", part) for part in ("lines", "parsed", "failed")]
        + [
            _report_row("response_code_share", "response_code", "NULL", "share"),
            _report_row("unique_hosts", "NULL", "hosts"),
            _report_row("daily_unique_hosts", "day", "hosts"),
            _report_row("daily_requests_per_host", "day", "requests_per_host"),
            _report_row("not_found_count", "NULL", "n"),
            _report_row("distinct_404_endpoints", "endpoint", "NULL"),
        ]
    ),
)
def access_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports of the log as rows of one table, from one pass over its lines."""
    summary = AccessSummary(access_log_lines(spark, sf_dir).select("line"))
    stats, quality = summary.content_size_stats(), summary.quality()
    found = {
        "response_code_counts": summary.response_code_counts(), "frequent_hosts": summary.frequent_hosts(),
        "any_n_hosts": summary.frequent_hosts().orderBy("host").limit(20), "endpoint_counts": summary.endpoint_counts(),
        "top_endpoints": summary.top_endpoints(), "top_error_endpoints": summary.top_error_endpoints(),
        "top_404_endpoints": summary.top_not_found_endpoints(), "top_404_hosts": summary.top_not_found_hosts(),
        "daily_404": summary.daily_not_found(), "top_404_days": summary.top_not_found_days(), "hourly_404": summary.hourly_not_found(),
        "unique_hosts": summary.unique_hosts(), "daily_unique_hosts": summary.daily_unique_hosts(),
        "daily_requests_per_host": summary.daily_requests_per_host(), "not_found_count": summary.not_found_count(),
        "distinct_404_endpoints": summary.not_found_endpoints(),
        "content_size_stats": stats.unpivot([], stats.columns, "key", "n"), "parse_quality": quality.unpivot([], quality.columns, "key", "n"),
        "response_code_share": summary.response_code_share().select("response_code", F.round("share", 6).alias("share")),
    }
    counts = ("n", "hosts", "requests_per_host")
    rows = None
    for name, df in found.items():
        key = next((c for c in df.columns if c not in (*counts, "share")), None)
        n = next((c for c in df.columns if c in counts), None)
        part = df.select(
            F.lit(name).alias("report"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
            (F.col(n) if n else F.lit(None)).cast("long").alias("n"), (F.col("share") if "share" in df.columns else F.lit(None)).cast("double").alias("value"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query(
    "parse_with_quality",
    """
    SELECT count(*) AS lines, count(*) FILTER (WHERE event_id % 97 <> 0) AS parsed,
           count(*) FILTER (WHERE event_id % 97 = 0) AS failed, count(*) FILTER (WHERE event_id % 97 <> 0) AS kept
    FROM events
    """,
)
def parse_with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load quality that came with the records in one pass, next to the number of records kept."""
    records, report = kept_with_quality(parse_access_log(access_log_lines(spark, sf_dir)))
    return report.withColumn("kept", records.agg(F.count("*")).scalar())

"""Reports from one pass against the reports computed one by one, and load quality that comes with the rows."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.counting import count_by, count_rows, integer_stats
from tallyloom.operators.ranking import top_by
from tallyloom.plans import access
from tallyloom.plans.access_summary import AccessSummary, grouped_counts
from tallyloom.sources.access_log import access_records, parse_access_log
from tallyloom.sources.quality import kept_with_quality, log_quality, record_quality
from tallyloom.sources.records import parse_products


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(2)
    texts = ["no log line", "", None]
    for _ in range(600):
        host = "hot.example" if rng.random() < 0.4 else f"h{rng.randrange(30)}.example"
        code = rng.choice([200, 200, 200, 304, 404, 404, 500])
        texts.append(
            f'{host} - - [{rng.randint(1, 9):02d}/Aug/1995:{rng.randint(0, 23):02d}:10:11 -0400] "GET /p{rng.randrange(50)} HTTP/1.0" {code} {rng.choice(["-", rng.randrange(9000)])}'
        )
    return spark.createDataFrame([(t,) for t in texts], "line string").repartition(5)


def same(left, right, ordered=False):
    assert left.columns == right.columns and left.dtypes == right.dtypes
    rows = [[tuple(r) for r in df.collect()] for df in (left, right)]
    assert rows[0] == rows[1] if ordered else sorted(rows[0]) == sorted(rows[1])


def test_every_report(lines):
    one, logs = AccessSummary(lines), access_records(lines)
    missing = access.not_found(logs)
    same(one.quality(), log_quality(parse_access_log(lines)))
    same(one.content_size_stats(), integer_stats(logs, "content_size"))
    same(one.response_code_counts(), count_by(logs, "response_code"))
    same(one.response_code_share(), access.response_code_share(logs))
    same(one.frequent_hosts(), access.frequent_hosts(logs))
    same(one.endpoint_counts(), count_by(logs, "endpoint"))
    same(one.top_endpoints(), access.top_endpoints(logs), True)
    same(one.top_error_endpoints(), access.top_endpoints(access.not_ok(logs)), True)
    same(one.unique_hosts(), access.unique_hosts(logs))
    same(one.daily_unique_hosts(), access.daily_unique_hosts(logs), True)
    same(one.daily_requests_per_host(), access.daily_requests_per_host(logs), True)
    same(one.not_found_count(), count_rows(missing))
    same(one.not_found_endpoints(), access.not_found_endpoints(logs), True)
    same(one.top_not_found_endpoints(), access.top_endpoints(missing, 20), True)
    same(one.top_not_found_hosts(), top_by(count_by(missing, "host"), 25, "n", "host"), True)
    same(one.daily_not_found(), access.daily_not_found(logs), True)
    same(one.top_not_found_days(), access.top_not_found_days(logs), True)
    same(one.hourly_not_found(), access.hourly_not_found(logs), True)


def test_lines_are_read_and_parsed_once(spark, lines, tmp_path):
    lines.write.text(str(tmp_path / "log"))
    plan = grouped_counts(spark.read.text(str(tmp_path / "log")), "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_a_log_without_records(spark):
    for texts in ([], ["nothing"]):
        one = AccessSummary(spark.createDataFrame([(t,) for t in texts], "line string"))
        assert tuple(one.quality().first()) == (len(texts), 0, len(texts))
        assert one.frequent_hosts(0).count() == one.daily_not_found().count() == one.endpoint_counts().count() == 0
        assert one.unique_hosts().first().hosts == 0 and one.not_found_count().first().n == 0


def test_quality_comes_with_the_rows(spark, lines):
    kept, report = kept_with_quality(parse_access_log(lines))
    same(report, log_quality(parse_access_log(lines)))
    assert kept.count() == report.first().parsed and kept.filter("parse_status <> 1").count() == 0
    products = spark.createDataFrame([('"id","title","description","manufacturer","price"',), ('"b1","paint box",,,9',), ("x",)], "line string")
    kept, report = kept_with_quality(parse_products(products), records=True)
    same(report, record_quality(parse_products(products)))
    assert [r.id for r in kept.collect()] == ["b1"]
    kept, report = kept_with_quality(parse_access_log(lines.limit(0)))
    assert kept.count() == 0 and tuple(report.first()) == (0, 0, 0)


def test_quality_is_counted_in_one_job(spark, lines, tmp_path):
    """The rows pass an accumulator once: as many as there are lines."""
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    counted = lines.mapInArrow(count, lines.schema)
    _, report = kept_with_quality(parse_access_log(counted))
    assert report.first().lines == passed.value == lines.agg(F.count("*")).first()[0]

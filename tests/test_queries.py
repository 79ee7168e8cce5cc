"""Every query against its SQL, and plans of all lazy queries."""

import compare
import pytest

import __spark_entry__ as entry
from tallyloom.catalog.tables import ratings

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.database(SF_DIR)


@pytest.mark.parametrize("name", sorted(name for name in SQL if not name.startswith("op") and name != "pipeline"))
def test_query_equals_sql(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare.difference(df, SQL[name], connection) is None


def test_every_query_has_sql_but_those_of_training_data():
    from tallyloom.catalog import QUERIES as own

    assert set(own) <= set(SQL)


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_no_sql_is_empty(sf_dir):
    from tallyloom.catalog import SQL as own

    tables = compare.database(sf_dir)
    allowed = {"parse_failures_sample"}
    empty = {name for name, sql in own.items() if not tables.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0]}
    assert empty <= allowed


def test_tables_show_files_added_later(spark, tmp_path):
    folder = f"{tmp_path}/lineitem.parquet"
    spark.range(5).write.parquet(folder)
    assert QUERIES["row_count"](spark, str(tmp_path)).first().n == 5
    spark.range(9).write.mode("append").parquet(folder)
    assert QUERIES["row_count"](spark, str(tmp_path)).first().n == 14


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "n"]


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_only_used_columns_are_read(spark):
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan_of(spark, "sum_by_key")
    chained = plan_of(spark, "filter_chain")
    assert "LessThan(o_totalprice,150000.0)]" in chained
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in chained


def test_top_needs_no_full_sort(spark):
    plan = plan_of(spark, "top_words")
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_log_pattern_runs_once_per_line(spark):
    assert plan_of(spark, "daily_404").count("regexp_replace(") == 1


def test_token_rows_are_not_shuffled_for_term_frequency(spark):
    assert plan_of(spark, "tf").count("Exchange hashpartitioning") == 1


def test_numbered_rows_are_not_shuffled_again(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "10")
    try:
        plan = plan_of(spark, "line_index")
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_copies_are_grouped_by_hash(spark):
    from tallyloom.catalog.tables import first_source
    from tallyloom.plans.similarity import representatives

    plan = representatives(first_source(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_parts_of_ratings_are_hashed_once(spark):
    from tallyloom.catalog.recommend import _parts

    parts = _parts(spark, SF_DIR)
    assert all("md5(" not in part._jdf.queryExecution().executedPlan().toString() for part in parts)
    assert sorted(tuple(row) for part in parts for row in part.collect()) == sorted(tuple(row) for row in ratings(spark, SF_DIR).collect())

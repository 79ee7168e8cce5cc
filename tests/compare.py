"""Comparison of a query's rows with its SQL, and a command-line report.

    python tests/compare.py [folder of tables] [query ...]
"""

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return "" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def types_of(df):
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    return {name: kinds.get(kind, kind) for name, kind in df.dtypes}


def difference(df, sql, connection):
    """None if rows and types agree, else what differs."""
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if expected[0] != actual[0]:
        return f"columns {actual[0]} instead of {expected[0]}"
    if types_of(df) != types:
        return f"types {types_of(df)} instead of {types}"
    if expected[1] != actual[1]:
        missing, extra = set(expected[1]) - set(actual[1]), set(actual[1]) - set(expected[1])
        return (
            f"{len(actual[1])} rows instead of {len(expected[1])}; missing {sorted(missing)[:3]}, extra {sorted(extra)[:3]}"
        )
    return None


def main(sf_dir, names):
    root = str(Path(__file__).resolve().parent.parent)
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from tallyloom.session import build_session

    spark = build_session("compare", "local[8]", 8, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    failed = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = difference(df, sql, connection) if sql else None
            note = "ok" if sql else f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or note}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])

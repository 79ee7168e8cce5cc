import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import cases  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return cases.documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, cases.SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], cases.SCHEMA)

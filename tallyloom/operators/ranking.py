"""Top and bottom rows in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def smallest(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` smallest rows by all given columns, repeats kept."""
    return df.orderBy(*[F.col(column).asc() for column in columns]).limit(n)


def largest(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The ``n`` largest rows by all given columns, repeats kept."""
    return df.orderBy(*[F.col(column).desc() for column in columns]).limit(n)


def top_by(df: DataFrame, n: int, measure: str | Column, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest measure; equal ones by ``ties`` ascending.

    Each task keeps its own ``n`` best rows, nothing is sorted as a whole.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    return df.orderBy(measure.desc(), *[F.col(tie).asc() for tie in ties]).limit(n)


def rating_title_order(rating: str, title: str, descending: bool = False) -> list[Column]:
    """Order by rating at three decimals (half to even), then title, then id-like ties by the caller.

    The two keys make the order independent of how the rows are partitioned.
    """
    keys = [F.bround(F.col(rating), 3), F.col(title)]
    return [key.desc() if descending else key.asc() for key in keys]

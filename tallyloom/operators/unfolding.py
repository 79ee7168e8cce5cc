"""One row per array element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(df: DataFrame, array: Column, name: str, *kept: str | Column) -> DataFrame:
    """The kept columns and each element of an array that holds no NULL.

    With a plain ``explode`` the optimizer adds a filter on the array's size
    below it, which computes the array a second time for every row. The outer
    form has no such filter; the NULL it gives for an empty array is dropped.
    """
    return df.select(*kept, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())

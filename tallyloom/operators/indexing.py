"""Dense row numbers without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stage_table

_ROW_BITS = 33


#: Offsets are broadcast for at most so many tasks, one short row each.
_OFFSETS = 200_000


def with_global_index(df: DataFrame, *order: str | Column, name: str = "index", part: str | None = None) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the given order; ``part`` names a column for the task that numbered a row.

    The rows are range-partitioned and sorted, and each task numbers its own.
    Equal keys are told apart by a tie-breaker, so that one value held by many
    rows is still cut into ranges. The tie-breaker counts the rows of a partition
    in the order of their hashes: a task that is run again gives the same ones,
    even if it receives its rows in another order. The numbered rows are staged,
    because the range borders must be the same when the offsets are counted and
    when they are added. Only one count per task is ever brought together.
    """
    settled = df.sortWithinPartitions(F.xxhash64(*df.columns))
    tied = settled.select(*df.columns, F.monotonically_increasing_id().alias("_tie"))
    ordered = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    numbered = stage_table(
        ordered.select(
            *df.columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per task: sent to the numbered rows, which then stay where they are.
    if offsets.count() <= _OFFSETS:
        offsets = F.broadcast(offsets)
    kept = [F.col("_part").alias(part)] if part else []
    return numbered.join(offsets, "_part").select(*df.columns, *kept, (F.col("_offset") + F.col("_row")).alias(name))

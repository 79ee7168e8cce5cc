"""Running user-written Python functions on whole tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

_KEYS_HELD = 100_000
_ROWS_OUT = 1 << 16
_NAN = float("nan")  # one object, so that it equals itself as a key


def row_function(func: Callable[[Any], Any], returns: str) -> Callable[[Column], Column]:
    """Turn a one-value Python function into a column function, run on Arrow batches."""

    @F.pandas_udf(returns)
    def apply(values: pd.Series) -> pd.Series:
        return values.map(func, na_action="ignore")

    return apply


def reduce_by_key(df: DataFrame, key: str, value: str, func: Callable[[Any, Any], Any]) -> DataFrame:
    """Combine the values of each key with an associative, commutative Python function.

    Every task first combines its own rows, so that a key leaves a task as a few
    partial values however many rows it has; the partial values are then sorted
    by key and combined as they stream by. No group is held in memory. Floating
    keys are grouped as in ``GROUP BY``: all NaN are one key, and so are 0.0 and -0.0.
    """

    def table(schema: pa.Schema, keys: list, values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, schema.field(0).type), pa.array(values, schema.field(1).type)], schema=schema
        )

    def combine_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[Any, Any] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for group, item in _pairs(batch):
                group = _NAN if group != group else group
                held[group] = func(held[group], item) if group in held else item
            if len(held) >= _KEYS_HELD:
                yield table(schema, list(held), list(held.values()))
                held = {}
        if held:
            yield table(schema, list(held), list(held.values()))

    def combine_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        values: list = []
        schema = None
        for batch in batches:
            schema = batch.schema
            for group, item in _pairs(batch):
                group = _NAN if group != group else group
                if keys and (keys[-1] is group or keys[-1] == group):
                    values[-1] = func(values[-1], item)
                else:
                    keys.append(group)
                    values.append(item)
            # The last key may go on in the next batch.
            if len(keys) > 1:
                yield table(schema, keys[:-1], values[:-1])
                keys, values = keys[-1:], values[-1:]
        if keys:
            yield table(schema, keys, values)

    kept = df.select(key, value)
    if kept.schema[key].dataType.typeName() in ("float", "double"):
        whole = F.when(F.isnan(key), F.lit(float("nan"))).when(F.col(key) == 0, F.lit(0.0)).otherwise(F.col(key))
        kept = kept.withColumn(key, whole.cast(kept.schema[key].dataType))
    return (
        kept.mapInArrow(combine_locally, kept.schema)
        .repartition(F.col(key))
        .sortWithinPartitions(key)
        .mapInArrow(combine_sorted, kept.schema)
    )


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[Any, Any]]:
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def map_partitions(df: DataFrame, func: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Run a function once per partition on an iterator of batches."""
    return df.mapInPandas(func, schema)


def map_partitions_with_index(
    df: DataFrame, func: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Like ``map_partitions``, and the function is told its partition's number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        return func(TaskContext.get().partitionId(), batches)

    return df.mapInPandas(run, schema)


class TableFunction:
    """A function of a table, told its rows as whole Arrow batches; state lives as long as a partition.

    ``rows`` is called for every batch, ``finish`` at the end of a partition; both yield Arrow tables.
    """

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        raise NotImplementedError

    def finish(self) -> Iterator[pa.Table]:
        return iter(())


def apply_table_function(
    df: DataFrame, make: Callable[[], TableFunction], returns: str | StructType, partition_by: Sequence[str] = (), order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Call a table function with ``df`` as its table argument.

    With ``partition_by`` all rows with equal values, nulls included, go in ``order_by`` order to a function object of their
    own; without it each task has one object for all its rows. Batches stream by, so no partition is held in memory.
    """

    class Handler:
        def __init__(self) -> None:
            self.function = make()

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
            yield from self.function.rows(batch)

        def terminate(self) -> Iterator[pa.Table]:
            yield from self.function.finish()

    argument = df.asTable()
    if partition_by:
        argument = argument.partitionBy(*partition_by)
        if order_by:
            argument = argument.orderBy(*order_by)
    return F.arrow_udtf(Handler, returnType=returns)(argument)


class NumbersBelow(TableFunction):
    """Each row once for 1, 2, ... up to but not including the number in a column, which goes into ``name``."""

    def __init__(self, column: str, name: str):
        self.column, self.name = column, name

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        names = batch.schema.names
        times = np.maximum(pc.fill_null(batch.column(names.index(self.column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) - 1, 0)
        ends, at = np.cumsum(times), 0
        # A row may stand for very many: a result table has at most about so many rows.
        while at < len(times):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _ROWS_OUT)))
            for low in range(0, int(times[at:stop].max(initial=0)) if stop == at + 1 else 1, _ROWS_OUT):
                n = np.clip(times[at:stop] - low, 0, _ROWS_OUT) if stop == at + 1 else times[at:stop]
                which = pa.array(np.repeat(np.arange(at, stop), n))
                numbers = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1 + low
                yield pa.table([*(c.take(which) for c in batch.columns), pa.array(numbers, pa.int64())], names=[*names, self.name])
            at = stop


class RunningSum(TableFunction):
    """Rows with their number from 1 and the sum of a whole-number column up to them, in the order they come."""

    def __init__(self, column: str):
        self.column, self.seen, self.total = column, 0, 0

    def rows(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        values = pc.fill_null(batch.column(batch.schema.names.index(self.column)).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
        sums = np.cumsum(values) + self.total
        yield pa.table([*batch.columns, pa.array(np.arange(1, len(values) + 1) + self.seen), pa.array(sums)], names=[*batch.schema.names, "number", "running"])
        if len(values):
            self.seen, self.total = self.seen + len(values), int(sums[-1])


def numbers_below(df: DataFrame, column: str, name: str) -> DataFrame:
    """All columns of ``df`` and ``name``: every row once for each whole number from 1 below ``column``; null counts as 0."""
    schema = StructType([*df.schema.fields, StructField(name, LongType())])
    return apply_table_function(df, lambda: NumbersBelow(column, name), schema)


def running_sums(df: DataFrame, column: str, partition_by: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """All columns of ``df``, ``number`` and ``running``: place and sum so far of a column within each partition; null adds nothing.

    The sum is of 64 bits. ``order_by`` should tell all rows of a partition apart.
    """
    schema = StructType([*df.schema.fields, StructField("number", LongType()), StructField("running", LongType())])
    return apply_table_function(df, lambda: RunningSum(column), schema, partition_by, order_by)


# Executors may not have this package on their path, so its functions travel as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

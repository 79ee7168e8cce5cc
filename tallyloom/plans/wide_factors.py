"""Factor models for ids of any size and for items that very many rows rate.

Spark's own training takes 32-bit ids and keeps all ratings of one item in one block. :func:`train_dense` gives it dense
numbers instead of ids and puts the ids back. :func:`train_in_parts` doesn't use it: ratings stay in blocks, factors are sent
to them, and an item with a third of all ratings is cut into parts whose sums are added up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.indexing import with_global_index
from tallyloom.plans import factors
from tallyloom.session import release_tables, stage_buckets, stage_table, staged_names, staged_tables

_LARGEST = (1 << 31) - 1


@dataclass(frozen=True)
class FactorTables:
    """Factors of users and items: two tables ``id long, features array<double>``, and their length."""

    users: DataFrame
    items: DataFrame
    rank: int


# Dense numbers ------------------------------------------------------------------------------------------------------


def dense_ids(ratings: DataFrame, column: str) -> DataFrame:
    """``id``, ``number``: the distinct ids of a column, numbered 0, 1, 2, ... in their order; nulls have no number."""
    ids = ratings.select(F.col(column).cast("long").alias("id")).filter("id is not null").distinct()
    numbered = with_global_index(ids, "id", name="number")
    if numbered.filter(F.col("number") > _LARGEST).limit(1).count():
        raise ValueError(f"more than 2^31 different values of {column}; train_in_parts takes them")
    return numbered.withColumn("number", F.col("number").cast("int"))


def train_dense(ratings: DataFrame, rank: int, blocks: int | None = None) -> FactorTables:
    """Train as :func:`tallyloom.plans.factors.train`, for user and item ids of 64 bits."""
    numbers = {name: dense_ids(ratings, name) for name in ("user_id", "item_id")}
    dense = ratings.select("user_id", "item_id", "rating")
    for name, table in numbers.items():
        dense = dense.join(table.select(F.col("id").alias(name), F.col("number").alias(f"_{name}")), name)
    model = factors.train(dense.select(F.col("_user_id").alias("user_id"), F.col("_item_id").alias("item_id"), "rating"), rank, blocks)

    def named(side: DataFrame, table: DataFrame) -> DataFrame:
        wide = F.transform("features", lambda x: x.cast("double")).alias("features")
        return side.select(F.col("id").alias("number"), wide).join(table, "number").select("id", "features")

    return FactorTables(named(model.userFactors, numbers["user_id"]), named(model.itemFactors, numbers["item_id"]), rank)


# Normal equations in parts ------------------------------------------------------------------------------------------


def initial_features(rank: int, seed: int = factors.SEED) -> Column:
    """A vector of length one from the hashes of an id, the same on every run."""
    parts = [F.xxhash64(F.lit(seed), F.lit(k), F.col("id")) / float(1 << 63) for k in range(rank)]
    length = F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))
    return F.array(*[F.try_divide(p, length) for p in parts])


def _solve(sums: np.ndarray, rank: int, regularization: float) -> np.ndarray:
    """Solutions of one equation per row: number of ratings, right side and upper triangle of the matrix."""
    upper, found = np.triu_indices(rank), np.empty((len(sums), rank))
    for k in range(0, len(sums), _SOLVED):
        some = sums[k : k + _SOLVED]
        matrix = np.zeros((len(some), rank, rank))
        matrix[:, upper[0], upper[1]] = matrix[:, upper[1], upper[0]] = some[:, 1 + rank :]
        matrix[:, range(rank), range(rank)] += regularization * some[:, :1]
        found[k : k + _SOLVED] = np.linalg.solve(matrix, some[:, 1 : 1 + rank, None])[:, :, 0]
    return found


#: Ratings of a block (about), the least number of blocks, and parts for heavy ids, per block. A task holds one block with its
#: factors, in the JVM and in Python: smaller blocks take less memory, but a factor goes to more of them.
_BLOCK_RATINGS, _LEAST_BLOCKS, _PARTS = 1 << 20, 16, 4
#: Counts by hash, among which the heavy ids are looked for.
_HASHES = 1 << 16
#: Ratings that a task packs together, numbers in a row of factors, ratings (about) that are unpacked and equations that are solved at once.
_PACKED, _ROW, _SLICE, _SOLVED = 1 << 18, 1 << 18, 1 << 18, 1 << 15
#: Iterations after which the factors are staged, so that plans stay short.
_STAGE_EVERY = 5
#: Compression of values, and bytes for their number.
_CODEC, _NUMBER = "zstd", 8
_RATINGS = "block int, split boolean, own binary, other binary, to binary, rating binary"
_FACTORS = "block int, kind int, ids binary, values binary"
#: Kinds of rows: factors, and those for the result, which are passed on; one more for sums of ids in parts instead of factors.
_SENT, _USERS, _ITEMS = 0, 2, 4


def _to_bytes(values: np.ndarray) -> bytes:
    """Their number, then compressed the first bytes of all values, the second bytes and so on: sorted ids and small numbers
    compress well like this. Rows stay compressed in the JVM, which holds all rows of a block at once."""
    plain = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return values.size.to_bytes(_NUMBER, "little") + pa.compress(plain, codec=_CODEC, asbytes=True)


def _number(row: pa.BinaryScalar) -> int:
    """How many values a row holds."""
    return int.from_bytes(memoryview(row.as_buffer())[:_NUMBER], "little")


def _from_bytes(column: Iterable[pa.BinaryScalar], kind: type) -> np.ndarray:
    """The values of all rows of a binary column, one after the other."""
    rows, size = list(column), np.dtype(kind).itemsize
    found, end = np.empty(sum(map(_number, rows)), kind), 0
    for row in rows:
        start, end = end, end + _number(row)
        plain = pa.decompress(row.as_buffer()[_NUMBER:], (end - start) * size, codec=_CODEC)
        found[start:end].view(np.uint8).reshape(-1, size)[:] = np.frombuffer(plain, np.uint8).reshape(size, -1).T
    return found


def _heavy(ratings: DataFrame, column: str, limit: int) -> DataFrame:
    """The ids with more ratings than ``limit`` and the parts that these are cut into.

    Ids are counted together by hash first, so the counts of most ids are never moved. Fewer than ``ratings / limit`` hashes have more.
    """
    hashed = ratings.select(column, F.pmod(F.xxhash64(column), F.lit(_HASHES)).alias("_hash"))
    crowded = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).filter(F.col("_n") > limit).select("_hash")
    counts = hashed.join(F.broadcast(crowded), "_hash", "left_semi").groupBy(column).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit)
    return stage_table(counts.select(column, (F.floor(F.col("_n") / limit) + 1).alias(f"_{column}_parts")))


def _block(own: str, other: str, blocks: int) -> Column:
    """The block that holds a rating for its ``own`` id: all ratings of an id are in one, those of a heavy id in one per part."""
    part = F.coalesce(F.pmod(F.xxhash64(F.lit(1), F.col(other)), F.col(f"_{own}_parts")), F.lit(0))
    return F.pmod(F.pmod(F.xxhash64(own), F.lit(blocks)) + part, F.lit(blocks)).cast("int")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the ratings that a task has of a block."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, split, *rest = [column.to_numpy() for column in pa.Table.from_batches(held).columns]
        place = block.astype(np.int64) * 2 + split
        order = np.lexsort((rest[0], place))
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        groups = np.split(order, cuts)
        first = [group[0] for group in groups]
        columns = [pa.array([_to_bytes(values[group]) for group in groups], pa.binary()) for values in rest]
        return pa.record_batch([pa.array(block[first]), pa.array(split[first]), *columns], names=["block", "split", "own", "other", "to", "rating"])

    held, rows = [], 0
    for batch in batches:
        held, rows = [*held, batch], rows + batch.num_rows
        if rows >= _PACKED:
            yield packed(held)
            held, rows = [], 0
    if rows:
        yield packed(held)


def place_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The ratings in blocks by user and in blocks by item, where they stay, and the number of blocks.

    A rating also has the other side's block that needs the factors of its ``own`` id. Of a heavy id no block has much more than others.
    """
    total = ratings.count()
    blocks = max(_LEAST_BLOCKS, -(-total // _BLOCK_RATINGS))
    limit = max(1, int(total / (_PARTS * blocks)))
    placed = ratings
    for name in ("user_id", "item_id"):
        placed = placed.join(F.broadcast(_heavy(ratings, name, limit)), name, "left")
    sides = []
    for own, other in (("user_id", "item_id"), ("item_id", "user_id")):
        split = F.col(f"_{own}_parts").isNotNull()
        side = placed.select(_block(own, other, blocks).alias("block"), split.alias("split"), own, other, _block(other, own, blocks).alias("to"), "rating")
        # Buckets are dealt by a hash of the block: with several to a block, few hold two blocks.
        sides.append(stage_buckets(side.mapInArrow(_pack, _RATINGS), "block", 4 * blocks))
    return sides[0], sides[1], blocks


def _slices(ratings: pa.Table, split: bool | None = None) -> Iterator[list[np.ndarray]]:
    """``own``, ``other``, ``to`` and ``rating`` of some of a block's ratings at a time; of ids in parts, of others or of both."""
    kinds, sizes = ratings["split"].to_pylist(), [_number(row) for row in ratings["own"]]
    chosen = [row for row, kind in enumerate(kinds) if split is None or kind == split]
    start = held = 0
    for end, row in enumerate(chosen, 1):
        held += sizes[row]
        if held >= _SLICE or end == len(chosen):
            columns = (("own", np.int64), ("other", np.int64), ("to", np.int32), ("rating", np.float64))
            yield [_from_bytes((ratings[name][k] for k in chosen[start:end]), kind) for name, kind in columns]
            start, held = end, 0


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; by sorting, which is faster here than the hashing of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _together(parts: list[np.ndarray]) -> np.ndarray:
    return _distinct(np.concatenate(parts)) if parts else np.empty(0, np.int64)


def _places(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted ids are in the sorted ``ids``; looked for in their order, which keeps to the cache."""
    order, found = np.argsort(wanted), np.empty(len(wanted), np.int64)
    found[order] = np.searchsorted(ids, wanted[order])
    return found


def _pairs(at: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
    """One number for a block and the place, below ``size``, of an id that it needs; each once."""
    return _distinct(to.astype(np.int64) * size + at)


def _wanted(pairs: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The blocks and the places of the ids that they need."""
    block, place = np.divmod(pairs, size)
    for group in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(block)) + 1):
        yield int(block[group[0]]), place[group]


def _first_ids(table: pa.Table) -> pa.Table:
    """The ids of a block's ratings, once for each block that needs their factors."""
    ids = _together([_distinct(own) for own, *_ in _slices(table)])
    pairs = _together([_pairs(_places(ids, own), to, len(ids)) for own, _, to, _ in _slices(table)])
    block, place = np.divmod(pairs, len(ids))
    return pa.table({"block": block.astype(np.int32), "id": ids[place]})


def _factor_rows(block: int, kind: int, ids: np.ndarray, values: np.ndarray) -> list[tuple]:
    step = max(1, _ROW // values.shape[1])
    return [(block, kind, _to_bytes(ids[k : k + step]), _to_bytes(values[k : k + step])) for k in range(0, len(ids), step)]


def _factor_batch(rows: list[tuple]) -> pa.Table:
    columns = {"block": pa.int32(), "kind": pa.int32(), "ids": pa.binary(), "values": pa.binary()}
    return pa.table({name: pa.array([row[k] for row in rows], data) for k, (name, data) in enumerate(columns.items())})


def _pack_factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``block``, ``id`` and ``features`` as factors for blocks."""
    for batch in batches:
        block, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        values = batch.column(2).flatten().to_numpy().reshape(len(ids), -1)
        rows = [row for k in np.unique(block) for row in _factor_rows(int(k), _SENT, ids[block == k], values[block == k])]
        yield from _factor_batch(rows).to_batches()


def _received(given: pa.Table, rank: int, regularization: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and their factors; the sums of ids in parts are added up and solved."""
    kinds = given["kind"].to_pylist()

    def values(name: str, kind: int, data: type) -> np.ndarray:
        return _from_bytes((row for row, found in zip(given[name], kinds) if found == kind), data)

    ids, vectors = values("ids", _SENT, np.int64), values("values", _SENT, np.float64).reshape(-1, rank)
    if _SENT + 1 in kinds:
        heavy, at = np.unique(values("ids", _SENT + 1, np.int64), return_inverse=True)
        sums = np.zeros((len(heavy), 1 + rank + rank * (rank + 1) // 2))
        np.add.at(sums, at, values("values", _SENT + 1, np.float64).reshape(-1, sums.shape[1]))
        ids, vectors = np.concatenate([ids, heavy]), np.concatenate([vectors, _solve(sums, rank, regularization)])
    order = np.argsort(ids, kind="stable")
    return ids[order], vectors[order]


def _add_up(sums: np.ndarray, at: np.ndarray, vectors: np.ndarray, rating: np.ndarray) -> None:
    """Add ratings, and the vectors of the other ids, to the number of ratings, right side and upper triangle of the matrix of each id."""
    x = np.ascontiguousarray(vectors.T)
    sums[:, 0] += np.bincount(at, minlength=len(sums))
    for column, (left, right) in enumerate([*((row, rating) for row in x), *((x[i], x[j]) for i, j in zip(*np.triu_indices(len(x))))], 1):
        sums[:, column] += np.bincount(at, left * right, len(sums))


def _half_step(rank: int, regularization: float, blocks: int, sent: bool, result: int | None):
    """From a block's ratings and the other side's factors, the factors of its own ids: ``sent`` to all blocks that need them,
    each once, and as a kind of ``result``. For ids in parts it is the part's sums, which go to every block."""

    def run(ratings: pa.Table, given: pa.Table) -> pa.Table:
        known, vectors = _received(given, rank, regularization)
        rows = [tuple(row.values()) for row in given.filter(pc.greater_equal(given["kind"], _USERS)).to_pylist()]
        found = []
        for split in (False, True):
            ids = _together([_distinct(own) for own, *_ in _slices(ratings, split)])
            values, pairs = np.zeros((len(ids), 1 + rank + rank * (rank + 1) // 2)), []
            for own, other, to, rating in _slices(ratings, split):
                at = _places(ids, own)
                _add_up(values, at, vectors[_places(known, other)], rating)
                if sent and not split:
                    pairs.append(_pairs(at, to, len(ids)))
            found.append((split, ids, values, _together(pairs)))
        del known, vectors
        for split, ids, values, pairs in found:
            if not len(ids):
                continue
            if not split:
                values = _solve(values, rank, regularization)
            if result is not None:
                rows += _factor_rows(ratings["block"][0].as_py(), result + split, ids, values)
            if sent and split:
                some = _factor_rows(0, _SENT + 1, ids, values)
                rows += [(block, *row[1:]) for block in range(blocks) for row in some]
            elif sent:
                for block, place in _wanted(pairs, len(ids)):
                    rows += _factor_rows(block, _SENT, ids[place], values[place])
        return _factor_batch(rows)

    return run


def _unpack(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = _from_bytes(batch.column(0), np.int64), _from_bytes(batch.column(1), np.float64)
            yield _features(ids, values.reshape(-1, width))

    return run


def _features(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(len(ids) + 1, dtype=np.int32) * values.shape[1]
    return pa.record_batch([pa.array(ids), pa.ListArray.from_arrays(ends, values.ravel())], names=["id", "features"])


def _solver(rank: int, regularization: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.stack([column.to_numpy() for column in batch.columns[1:]], axis=1)
            yield _features(batch.column(0).to_numpy(), _solve(sums, rank, regularization))

    return run


def _result(found: DataFrame, kind: int, rank: int, regularization: float) -> DataFrame:
    """``id``, ``features`` of one side; the sums of ids in parts are added up first."""
    whole = found.filter(F.col("kind") == kind).select("ids", "values").mapInArrow(_unpack(rank), "id long, features array<double>")
    width = 1 + rank + rank * (rank + 1) // 2
    parts = found.filter(F.col("kind") == kind + 1).select("ids", "values").mapInArrow(_unpack(width), "id long, features array<double>")
    sums = parts.groupBy("id").agg(*[F.sum(F.col("features")[k]).alias(f"_{k}") for k in range(width)])
    return whole.unionByName(sums.mapInArrow(_solver(rank, regularization), "id long, features array<double>"))


def train_in_parts(
    ratings: DataFrame, rank: int, iterations: int = factors.ITERATIONS, regularization: float = factors.REGULARIZATION, seed: int = factors.SEED
) -> FactorTables:
    """Alternating least squares on ids of 64 bits; the regularisation of a user or item grows with its ratings.

    Ratings are placed once in blocks by user and once in blocks by item. In a half-step they stay where they are, and only the
    factors of the other side are moved, once to each block that needs them. An id with many ratings is in several blocks: these send
    their sums of its equation, which are added up where its factors are needed. Factors are staged after every fifth iteration and the last;
    all but the last are released. Ratings with a null id or rating are left out; repeated ratings all count.
    """
    if iterations < 1:
        raise ValueError("at least one iteration is needed")
    spark, mark = ratings.sparkSession, staged_tables()
    whole = stage_table(
        ratings.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"), F.col("rating").cast("double").alias("rating")).dropna()
    )
    by_user, by_item, blocks = place_ratings(whole)

    def half(side: DataFrame, known: DataFrame, sent: bool, result: int | None) -> DataFrame:
        step = _half_step(rank, regularization, blocks, sent, result)
        return side.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(step, _FACTORS)

    first = by_user.groupBy("block").applyInArrow(_first_ids, "block int, id long")
    users = first.select("block", "id", initial_features(rank, seed).alias("features")).mapInArrow(_pack_factors, _FACTORS)
    for done in range(1, iterations + 1):
        last = done == iterations
        items = half(by_item, users, True, _ITEMS if last else None)
        users = half(by_user, items, not last, _USERS if last else None)
        if last or done % _STAGE_EVERY == 0:
            users = stage_table(users)
    tables = [stage_table(_result(users, kind, rank, regularization)) for kind in (_USERS, _ITEMS)]
    release_tables(spark, staged_names(mark)[:-2])
    return FactorTables(*tables, rank)


# Use ----------------------------------------------------------------------------------------------------------------


def _dot(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _with_features(pairs: DataFrame, tables: FactorTables) -> DataFrame:
    users = tables.users.select(F.col("id").alias("user_id"), F.col("features").alias("_user"))
    items = tables.items.select(F.col("id").alias("item_id"), F.col("features").alias("_item"))
    return pairs.join(items, "item_id").join(users, "user_id")


def predict(tables: FactorTables, pairs: DataFrame) -> DataFrame:
    """``user_id``, ``item_id``, ``prediction`` for the pairs whose user and item were both seen in training."""
    return _with_features(pairs.select("user_id", "item_id"), tables).select("user_id", "item_id", _dot("_user", "_item").alias("prediction"))


def user_residuals(tables: FactorTables, ratings: DataFrame, regularization: float = factors.REGULARIZATION) -> DataFrame:
    """``user_id``, ``residual``: how far each user's factors are from solving their own equation, relative to the ratings."""
    joined = _with_features(ratings, tables)
    error = _dot("_user", "_item") - F.col("rating")
    sums = [F.sum(error * F.col("_item")[k]) + regularization * F.count("*") * F.max(F.col("_user")[k]) for k in range(tables.rank)]
    gradient = joined.groupBy("user_id").agg(F.sum(F.abs("rating")).alias("_total"), *[s.alias(f"_g{k}") for k, s in enumerate(sums)])
    length = F.sqrt(sum((F.col(f"_g{k}") * F.col(f"_g{k}") for k in range(1, tables.rank)), F.col("_g0") * F.col("_g0")))
    return gradient.select("user_id", F.try_divide(length, F.col("_total")).alias("residual"))


# Executors may have no copy of this package: its functions travel as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

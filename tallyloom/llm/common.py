"""Helpers of the training-data operators: staging, packed document shards, exchanges, byte scans.

Operators that compare documents with each other work on *shards*: some
megabytes of whole documents packed into one compressed row. A shard is written
once to the shared folder, so later passes read a copy a third as large as the
input and a lost executor costs only the shards it was working on. Facts about
a shard travel as ``(part, shard, blob)`` rows: a pass over the shards asks, the
part that owns a range of hashes answers, and the answers meet the shard again.
Every blob is already deduplicated within its shard, so a key that is in a third
of all documents is one entry per shard, not one per document.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyloom.session import stage_buckets, stage_table

#: Raw bytes of text packed into one shard; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
#: Raw bytes of text in one bucket of shards, as a mean.
BUCKET_BYTES = 8 << 20
#: Rows of one Arrow batch, so that a batch of long documents stays small.
BATCH_ROWS = 1000
#: Ends every packed text; no UTF-8 text holds this byte.
END = 0xFF
_DOC_BITS = 20
#: Words hashed at a time.
_RUNS = 1 << 14

SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


# Staging ------------------------------------------------------------------------------------------------------------


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors.

    Spark removes the shuffle files of earlier jobs when the driver has collected what refers to them, so the driver
    is asked to do that here, between jobs, rather than whenever its memory runs low.
    """
    table = stage_table(df, "zstd")
    del df
    _forget_shuffles(table.sparkSession)
    return table


def _forget_shuffles(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def limit_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS``, if it is larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Return memory that this worker has freed to the system: workers are reused, and the next task may be of another kind."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the GNU library has it
        pass


# Shards -------------------------------------------------------------------------------------------------------------


def _row_blob(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches have ``doc_id``, ``text`` and then the columns that are carried along."""
    task, made = TaskContext.get().partitionId(), 0
    held: list[pa.Table] = []
    rows = size = 0

    def flush():
        nonlocal made, rows, size
        row = {"shard": [(task << 20) | made], "n_docs": [rows], "n_bytes": [size], "payload": pa.array([_row_blob(pa.concat_tables(held))], pa.binary())}
        made, rows, size = made + 1, 0, 0
        held.clear()
        return pa.record_batch(row)

    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
        text = pc.binary_join_element_wise(text, pa.scalar(b"", pa.large_binary()), pa.scalar(b"\xff", pa.large_binary()))
        table = pa.Table.from_batches([batch]).set_column(1, "text", text)
        lengths, start = pc.binary_length(text).to_pylist(), 0
        for i, length in enumerate(lengths):
            if rows and (size + length > limit or rows >= (1 << _DOC_BITS) - 1):
                held.append(table.slice(start, i - start))
                start = i
                yield flush()
            rows, size = rows + 1, size + length
        held.append(table.slice(start))
    if rows:
        yield flush()
    give_back()


def shards_of(docs: DataFrame, shard_bytes: int = SHARD_BYTES, carry: bool = False) -> DataFrame:
    """Stage ``doc_id`` and ``text`` of every row as shards: ``shard, n_docs, n_bytes, payload``.

    A null text is packed as empty; rows with equal or null ids stay rows of their own. With ``carry`` all columns
    travel in the shard, for :func:`whole_rows`.
    """
    return staged(_packed(docs, shard_bytes, carry))


def bucketed_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, carry: bool = False) -> tuple[DataFrame, int]:
    """As :func:`shards_of`, but in buckets by ``shard``, and their number.

    The texts are shuffled once, here. What is later known of the shards comes to them (:func:`to_buckets`), however
    much it is, and the shards stay where they are.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = int(min(max(1, total // BUCKET_BYTES), 1 << 16))
    shards = stage_buckets(_packed(docs, shard_bytes, carry), "shard", buckets, "zstd")
    _forget_shuffles(docs.sparkSession)
    return shards, buckets


def to_buckets(facts: DataFrame, buckets: int, fact: Column) -> DataFrame:
    """One row per ``shard`` with an aggregate of its facts, in as many parts as there are buckets of shards."""
    return facts.repartition(buckets, "shard").groupBy("shard").agg(fact)


def _packed(docs: DataFrame, shard_bytes: int, carry: bool) -> DataFrame:
    limit_batches(docs.sparkSession)
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if carry:
        # Of the text, which is there already, only whether it is null.
        own = [F.col(f"`{name}`") for name in docs.columns]
        columns += [(c.isNull() if name == "text" else c).alias(f"carried {i}") for i, (name, c) in enumerate(zip(docs.columns, own, strict=True))]
    return docs.select(*columns).mapInArrow(
        lambda batches: _pack(batches, shard_bytes), "shard long, n_docs long, n_bytes long, payload binary"
    )


def whole_rows(shards: DataFrame, schema: StructType, texts: Callable[..., list[str]], *extra: str) -> DataFrame:
    """The carried rows with new texts, and ``n_chars`` to match if there is such a column.

    ``texts`` gives the new text of each document of a shard.
    """
    fields, names = to_arrow_schema(schema), schema.names

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one payload at a time
                row = {name: batch.column(place)[i].as_py() for place, name in enumerate(("shard", "payload", *extra))}
                shard = unpack(row["shard"], row["payload"])
                new = texts(shard, *(row[name] for name in extra))
                columns = [shard.table.column(f"carried {k}") for k in range(len(names))]
                columns[names.index("text")] = _texts(new, columns[names.index("text")])
                if "n_chars" in names:
                    columns[names.index("n_chars")] = pa.chunked_array([pa.array([len(n) for n in new], pa.int64())])
                arrays = [c.combine_chunks().cast(f.type) for c, f in zip(columns, fields, strict=True)]
                yield pa.record_batch([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], schema=fields)
        give_back()

    return shards.select("shard", "payload", *extra).mapInArrow(run, schema)


def _texts(texts: list[str], none) -> pa.ChunkedArray:
    return pa.chunked_array([pa.array([None if gone else text for text, gone in zip(texts, none.to_pylist(), strict=True)], pa.string())])


def chosen_rows(shards: DataFrame, schema: StructType, rows: str) -> DataFrame:
    """Some of the carried rows; the column ``rows`` has their places in the shard."""
    fields = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one payload at a time
                shard, payload, places = (batch.column(place)[i].as_py() for place in range(3))
                table = unpack(shard, payload).table.take(pa.array(sorted(places), pa.int64()))
                columns = [table.column(f"carried {k}").combine_chunks() for k in range(len(fields))]
                texts = [text[:-1].decode() for text in table.column("text").to_pylist()]
                columns[fields.names.index("text")] = _texts(texts, columns[fields.names.index("text")])
                arrays = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.record_batch([a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)
        give_back()

    return shards.select("shard", "payload", rows).mapInArrow(run, schema)


def parts_for(shards: DataFrame, part_bytes: int = 2 << 20) -> int:
    """A number of parts in proportion to the packed bytes; at most 65,536, beyond which parts grow with the input."""
    total = shards.agg(F.sum("n_bytes")).first()[0] or 0
    return int(min(max(4, total // part_bytes), 1 << 16))


class Shard(SimpleNamespace):
    """One unpacked shard.

    ``buffer`` holds all texts one after the other, each ended by ``END``; text i is
    ``buffer[offsets[i]:offsets[i + 1] - 1]``. ``ids`` has the smallest long for a null id, ``known`` tells which are not null.
    """

    def text(self, i: int) -> bytes:
        return self.buffer[self.offsets[i] : self.offsets[i + 1] - 1].tobytes()


def unpack(shard: int, payload: bytes) -> Shard:
    table = pa.ipc.open_stream(pa.py_buffer(payload)).read_all().combine_chunks()
    ids, texts = table.column("doc_id").combine_chunks(), table.column("text").combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return Shard(
        shard=shard,
        buffer=buffer,
        offsets=offsets - offsets[0],
        ids=pc.fill_null(ids, np.iinfo(np.int64).min).to_numpy(zero_copy_only=False),
        known=pc.is_valid(ids).to_numpy(zero_copy_only=False),
        n=len(ids),
        table=table,
    )


def loose_shard(texts: list[bytes | None]) -> Shard:
    """Texts of one batch in the form of a shard, without ids; null texts are empty."""
    texts = [text or b"" for text in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    return Shard(buffer=np.frombuffer(b"\xff".join([*texts, b""]), np.uint8), offsets=offsets, n=len(texts))


def id_array(shard: Shard, chosen=None) -> pa.Array:
    """The ids as Arrow longs, null where they were null."""
    take = slice(None) if chosen is None else chosen
    return pa.array(shard.ids[take], pa.int64(), mask=~shard.known[take])


def map_shards(shards: DataFrame, make: Callable[[Shard], Iterator[dict]], schema: str, *extra: str) -> DataFrame:
    """Run ``make`` on each shard; it yields columns (name to array) of the result.

    ``extra`` names columns of ``shards`` that are handed to ``make`` as further arguments.
    """
    fields = pa_schema(schema)

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {name: batch.column(names.index(name))[i].as_py() for name in ("shard", "payload", *extra)}
                for columns in make(unpack(row["shard"], row["payload"]), *(row[name] for name in extra)):
                    yield record_batch(columns, fields)
        give_back()

    return shards.select("shard", "payload", *extra).mapInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def pa_schema(schema: str) -> pa.Schema:
    """An Arrow schema for a list of plain columns, as in ``"a long, b binary"``."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in schema.split(","))])


def record_batch(columns: dict, fields: pa.Schema) -> pa.RecordBatch:
    arrays = [a if isinstance(a := columns[f.name], pa.Array) else pa.array(a, f.type) for f in fields]
    return pa.record_batch([a.cast(f.type) for a, f in zip(arrays, fields, strict=True)], schema=fields)


def blobs_by_part(part: np.ndarray, n_parts: int, *arrays: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """Per non-empty part: its number, the positions of its entries, and the bytes of each array at them."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in range(n_parts):
        if ends[p] < ends[p + 1]:
            at = order[ends[p] : ends[p + 1]]
            yield p, at, [a[at].tobytes() for a in arrays]


def part_of(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    """The part that owns each hash; uses the high bits, whatever the low bits are used for."""
    return ((hashes >> np.uint64(40)) % np.uint64(n_parts)).astype(np.int64)


def shared_flags(shards: DataFrame, keys: Callable[..., tuple[np.ndarray, np.ndarray]], n_parts: int, *extra: str, buckets: int | None = None) -> DataFrame:
    """Which keys of a shard may occur more than once anywhere: ``shard, answers`` with one bit per key.

    ``keys`` gives for a shard its distinct 64-bit keys in ascending order and whether each occurs there more than
    once. 32 bits of a key besides its part travel, so a bit may be set for a key that occurs once (about one in a
    thousand), but is never missing. With ``buckets`` the answers are dealt as the buckets of shards are.
    """

    def ask(shard, *more):
        found, twice = keys(shard, *more)
        part = part_of(found, n_parts)
        rows = [(p, len(at), a, np.packbits(twice[at]).tobytes()) for p, at, (a,) in blobs_by_part(part, n_parts, found.astype(np.uint32))]
        if rows:
            yield {"part": [r[0] for r in rows], "shard": [shard.shard] * len(rows), "n": [r[1] for r in rows], "keys": [r[2] for r in rows], "twice": [r[3] for r in rows]}

    def answer(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(b)) for x, b in zip(table.column("twice").to_pylist(), blobs, strict=True)]
        every = np.concatenate(blobs)
        values, inverse, count = np.unique(every, return_inverse=True, return_counts=True)
        shared = (count > 1) | (np.bincount(inverse, np.concatenate(twice), len(values)) > 0)
        bits, ends = shared[inverse], np.cumsum([0, *map(len, blobs)])
        packed = [np.packbits(bits[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({"part": table.column("part"), "shard": table.column("shard"), "bits": pa.array(packed, pa.binary())})

    asked = map_shards(shards, ask, "part long, shard long, n long, keys binary, twice binary", *extra)
    answers = asked.groupBy("part").applyInArrow(answer, "part long, shard long, bits binary")
    gathered = F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("answers")
    return to_buckets(answers, buckets, gathered) if buckets else answers.groupBy("shard").agg(gathered)


def read_flags(found: np.ndarray, n_parts: int, answers) -> np.ndarray:
    """The answers of :func:`shared_flags` for the same keys, in their order."""
    part, flags = part_of(found, n_parts), np.zeros(len(found), bool)
    by_part = {a["part"]: a["bits"] for a in answers or ()}
    for p, at, _ in blobs_by_part(part, n_parts):
        flags[at] = np.unpackbits(np.frombuffer(by_part[p], np.uint8), count=len(at)).astype(bool)
    return flags


def in_sorted(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def distinct_with_twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, count = np.unique(keys, return_counts=True)
    return values, count > 1


# Byte scans ---------------------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache
def _byte_codes() -> np.ndarray:
    codes = np.frombuffer(hashlib.shake_256(b"byte codes").digest(2048), np.uint64).copy()
    return codes | np.uint64(1)


_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(n, base, np.uint64))


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of an odd number, modulo 2^64."""
    return _powers(_BASE, 1 << max(10, int(n).bit_length()))


def inverse_powers(n: int) -> np.ndarray:
    return _powers(pow(_BASE, -1, 1 << 64), 1 << max(10, int(n).bit_length()))


@lru_cache
def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@lru_cache
def separator_table(separators: tuple[int, ...]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[*separators, END]] = True
    return table


def words_of(buffer: np.ndarray, separators: tuple[int, ...] = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that are no separators."""
    gap = np.ones(len(buffer) + 2, np.int8)
    gap[1:-1] = separator_table(separators)[buffer]
    edges = np.flatnonzero(np.diff(gap))
    return edges[::2], edges[1::2]


def run_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the disjoint ascending runs."""
    hashes = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), _RUNS):  # little memory, and in the processor's cache
        first, length = starts[at : at + _RUNS], ends[at : at + _RUNS] - starts[at : at + _RUNS]
        heads = np.cumsum(length) - length
        within = np.arange(length.sum()) - np.repeat(heads, length)
        weighted = _byte_codes()[buffer[within + np.repeat(first, length)]] * powers(int(length.max()))[within]
        hashes[at : at + _RUNS] = mix(np.add.reduceat(weighted, heads) + length.astype(np.uint64))
    return hashes


def firsts_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the first run of each document, and the total at the end."""
    return np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive word hashes, documents ignored; empty if there are fewer."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        total += hashes[j : j + len(total)] * powers(k)[j]
    return mix(total)


def valid_starts(firsts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n positions start k items of one document; ``firsts`` as of :func:`firsts_of`."""
    room = np.repeat(firsts[1:], np.diff(firsts))[:n] - np.arange(n)
    return room >= k


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in every window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, span = np.arange(len(values)), 1
    while span * 2 <= width:
        a, b = best[: len(best) - span], best[span:]
        best = np.where(values[b] < values[a], b, a)
        span *= 2
    a, b = best[:n], best[width - span : width - span + n]
    return np.where(values[b] < values[a], b, a)


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans; touching spans are joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new], ends[last]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n positions lie in any of the half-open spans."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edges[:-1]) > 0


def cut_texts(shard: Shard, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts of a shard without the given byte spans, which begin and end between characters."""
    keep = ~covered(len(shard.buffer), starts, ends)
    at = np.concatenate([[0], np.cumsum(keep)])[shard.offsets]
    kept = shard.buffer[keep].tobytes()
    return [kept[a : b - 1].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# Groups -------------------------------------------------------------------------------------------------------------


def map_groups(df: DataFrame, keys: list[str], make: Callable[[dict[str, list]], Iterator[dict]], schema: str) -> DataFrame:
    """Hand the rows of each group, as lists by column, to ``make``; for many small groups of bounded size.

    Groups are streamed through few Python calls per partition rather than one worker round trip each.
    """
    fields = pa_schema(schema)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def whole(table: pa.Table, final: bool):
            """Yield the groups of ``table``; without ``final`` the last one is left open and returned."""
            columns = table.to_pydict()
            rows = list(zip(*(columns[k] for k in keys), strict=True))
            start = 0
            for i in range(1, len(rows) + 1):
                if i == len(rows):
                    if final:
                        yield {name: values[start:] for name, values in columns.items()}
                elif rows[i] != rows[start]:
                    yield {name: values[start:i] for name, values in columns.items()}
                    start = i
            held.clear()
            if not final and rows:
                held.extend(table.slice(start).combine_chunks().to_batches())

        for batch in batches:
            if not batch.num_rows:
                continue
            if held and all(batch.column(batch.schema.names.index(k))[-1].as_py() == held[0].column(held[0].schema.names.index(k))[0].as_py() for k in keys):
                held.append(batch)  # the group goes on
                continue
            for group in whole(pa.Table.from_batches([*held, batch]), False):
                for columns in make(group):
                    yield record_batch(columns, fields)
        if held:
            for group in whole(pa.Table.from_batches(held), True):
                for columns in make(group):
                    yield record_batch(columns, fields)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)

"""Near duplicates by SimHash fingerprints, their pairs found by pigeonring filtering.

Cut the 64 bits into 16 segments on a ring. If two fingerprints differ in at most 4 bits, some segment starts a chain
in which the first k segments together differ in at most k * 4 / 16 bits, for every k: none in 3, one in 7, two in 11,
three in 15. So the pair agrees on the first three segments of that chain and on three of the next four. These 64 keys
(a start and a segment left out) bring candidates together; the rest of the chain is checked for each of them, and
only what passes is compared as a whole. Nothing is lost: each pair within the distance passes from at least one start.

Equal fingerprints are one before any key is made. A key's fingerprints stream in order through one task. A key with
more than a block of them is cut into blocks, and each pair of blocks becomes a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C
from tallyloom.llm.components import connected_components

BITS, SEGMENTS, DISTANCE = 64, 16, 4
WIDTH = BITS // SEGMENTS
#: Segments of a chain that a key is made from: the last WIDTH of them without one.
_HEAD, _TAIL = 3, 4
#: Fingerprints of a key that are compared with each other at once.
BLOCK = 4096
#: Shingles hashed at a time.
_SHINGLES = 1 << 14
_SEED = 42


# Fingerprints -------------------------------------------------------------------------------------------------------


def fingerprint(text: bytes | None, k: int = 4) -> int:
    """The bits set in over half the shingle hashes of a text; 0 without words."""
    words = (text or b"").lower().split()  # both know ASCII only
    joined = np.frombuffer(b" ".join(words), np.uint8)
    if not len(joined):
        return 0
    raw, gaps = joined.tobytes(), np.flatnonzero(joined == 0x20)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(joined))
    if len(starts) > k:
        starts, ends = starts[: 1 - k], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SHINGLES):
        pieces = [raw[a:b] for a, b in zip(starts[at : at + _SHINGLES].tolist(), ends[at : at + _SHINGLES].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(_SEED)), np.uint64, len(pieces))
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """``doc_id, bits`` for every row: the fingerprint of its whole text as a long."""
    C.limit_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [fingerprint(text.as_buffer().to_pybytes() if text.is_valid else None, k) for text in batch.column(1)]
            yield pa.record_batch({"doc_id": batch.column(0), "bits": np.array(found, np.uint64).view(np.int64)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, bits long")


# Pigeonring ---------------------------------------------------------------------------------------------------------


def _rotated(bits: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The ring from a segment on, that segment in the highest bits."""
    by = (start * WIDTH).astype(np.uint64)
    return (bits << by) | (bits >> ((np.uint64(BITS) - by) % np.uint64(BITS)))


def keys_of(bits: Column) -> Column:
    """The 64 keys of a fingerprint: start of the chain, segment left out, and the bits of the others."""
    keys, chain = [], _HEAD + _TAIL
    for start in range(SEGMENTS):
        by = start * WIDTH
        ring = F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by)) if by else bits
        top = F.shiftrightunsigned(ring, BITS - WIDTH * chain)
        for out in range(_TAIL):
            mask = ((1 << WIDTH * chain) - 1) ^ (((1 << WIDTH) - 1) << (WIDTH * out))
            keys.append(top.bitwiseAND(F.lit(mask).cast("long")).bitwiseOR(F.lit((start * _TAIL + out) << (WIDTH * chain)).cast("long")))
    return F.array(*keys)


def start_of(keys: np.ndarray) -> np.ndarray:
    """The segment at which the chain of a key starts."""
    return (keys >> (WIDTH * (_HEAD + _TAIL))) // _TAIL


def chain_holds(difference: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Positions of the differences whose chain from ``start`` stays within budget all the way round.

    Budgets are whole numbers, so they bind only where the next bit is about to be allowed.
    """
    ring, left = _rotated(difference, start), np.arange(len(difference))
    for allowed in range(DISTANCE + 1):
        length = min(SEGMENTS, -(-(allowed + 1) * SEGMENTS // DISTANCE) - 1)
        mask = np.uint64(((1 << WIDTH * length) - 1) << (BITS - WIDTH * length))
        left = left[np.bitwise_count(ring[left] & mask) <= allowed]
    return left


def _runs(keys: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs within the runs of equal keys, one distance in the list after the other."""
    here = np.flatnonzero(keys[1:] == keys[:-1])
    apart = 1
    while len(here):
        kept = here[chain_holds(bits[here] ^ bits[here + apart], start_of(keys[here]))]
        if len(kept):
            yield bits[kept], bits[kept + apart]
        apart += 1
        here = here[here + apart < len(keys)]
        here = here[keys[here] == keys[here + apart]]


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
    """The pairs, or as few links as join the same fingerprints where there are more pairs than fingerprints."""
    if not pairs:
        return None
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    if len(a) > len(nodes):
        u, v, label = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
        while True:
            least = np.minimum(label[u], label[v])
            before = label.copy()
            np.minimum.at(label, u, least)
            np.minimum.at(label, v, least)
            label = label[label]
            if np.array_equal(label, before):
                break
        own = np.flatnonzero(label != np.arange(len(nodes)))
        a, b = nodes[label[own]], nodes[own]
    return _edges(a, b)


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), none, none], schema=_FOUND)


_FOUND_SCHEMA = "a long, b long, key long, block long"
_FOUND = C.pa_schema(_FOUND_SCHEMA)


def _compare_sorted(block: int):
    """Links of rows ``key, bits`` in order of both; rows of a key beyond one block also come back with their block."""

    def run(batches):
        keys, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        cut, placed = None, 0  # a key that has more than a block so far, and its blocks

        def crowd(members: np.ndarray):
            nonlocal placed
            size = len(members)
            yield pa.record_batch([pa.array(members.view(np.int64)), pa.nulls(size, pa.int64()), pa.array(np.full(size, cut)), pa.array(np.full(size, placed))], schema=_FOUND)
            links = _forest(list(_runs(np.full(size, cut), members)))
            if links is not None:
                yield links
            placed += 1

        def done(final: bool):
            """Handle all keys but the last, and whole blocks of the last one."""
            nonlocal keys, bits, cut, placed
            while len(keys):
                if cut is not None:
                    mine = int(np.searchsorted(keys, cut, side="right"))
                    if mine < block and mine == len(keys) and not final:
                        return
                    size = min(mine, block)
                    if size:
                        yield from crowd(bits[:size])
                    keys, bits = keys[size:], bits[size:]
                    if size == mine and (len(keys) or final):
                        cut = None
                    continue
                heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                sizes = np.diff(np.append(heads, len(keys)))
                large = np.flatnonzero(sizes > block)
                upto = heads[large[0]] if len(large) else (len(keys) if final else heads[-1])
                if upto:
                    links = _forest(list(_runs(keys[:upto], bits[:upto])))
                    if links is not None:
                        yield links
                    keys, bits = keys[upto:], bits[upto:]
                if not len(large):
                    return
                cut, placed = keys[0], 0

        for batch in batches:
            keys = np.append(keys, batch.column(0).to_numpy())
            bits = np.append(bits, batch.column(1).to_numpy().view(np.uint64))
            if len(keys) > 4 * block:
                yield from done(False)
        yield from done(True)

    return run


def _compare_blocks(rows: dict[str, list]) -> Iterator[dict]:
    """Links between two blocks of a key."""
    bits, side = np.array(rows["bits"], np.int64).view(np.uint64), np.array(rows["own"])
    left, right = bits[side == rows["x"][0]], bits[side == rows["y"][0]]
    start, pairs = start_of(np.full(1, rows["key"][0])), []
    for bit in left:
        kept = chain_holds(bit ^ right, start)
        pairs.append((np.full(len(kept), bit), right[kept]))
    links = _forest([p for p in pairs if len(p[0])])
    if links is not None:
        yield {"a": links.column(0), "b": links.column(1)}


def links(bits: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a, b``: links that join the distinct fingerprints ``bits`` exactly as all pairs within 4 bits do.

    Where a key has more pairs than fingerprints, a few links stand for them that join the same fingerprints.
    """
    keyed = bits.select(F.explode(keys_of(F.col("bits"))).alias("key"), "bits")
    found = C.staged(keyed.repartition("key").sortWithinPartitions("key", "bits").mapInArrow(_compare_sorted(block), _FOUND_SCHEMA))
    crowded = found.filter("block is not null").select("key", F.col("block").alias("own"), F.col("a").alias("bits"))
    counts = crowded.groupBy("key").agg((F.max("own") + 1).alias("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    against = crowded.join(counts, "key").select("key", "own", "bits", other).filter("own <> other")
    paired = against.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "bits")
    more = C.map_groups(paired, ["key", "x", "y"], _compare_blocks, "a long, b long")
    return found.filter("block is null").select("a", "b").unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    A fingerprint has the bits that are set in over half the XXH64 hashes (seed 42) of a text's 4-word shingles, repeats
    included; a text of fewer words is one shingle, one without words, empty or null has the fingerprint zero. Rows are
    linked where their fingerprints differ in at most 4 bits, equal and zero ones included. The component is the
    smallest id that links reach; null ids do not count, and a component of nothing else has none. Rows with
    equal or null ids are rows of their own.
    """
    found = C.staged(fingerprints(docs))
    first = C.staged(found.groupBy("bits").agg(F.min("doc_id").alias("first")))
    joined = connected_components(links(first.select("bits")))
    of_bits = first.join(joined.select(F.col("node").alias("bits"), "component"), "bits", "left").select("bits", "first", F.coalesce("component", "bits").alias("component"))
    least = of_bits.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of_bits.select("bits", "component").join(least, "component").select("bits", "component_id")
    return found.join(named, "bits").select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")

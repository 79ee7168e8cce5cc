"""Documents that contain given passages, found by winnowed anchors.

Every passage is known by one anchor: the smallest hash of the strings of k bytes in it. In each window of w such
strings a document keeps the smallest hash. A document that contains the passage has all the passage's windows, and
one of these holds its anchor as the smallest, so documents and passages meet on anchors alone. The scan of the documents drops
anchors that are not in a Bloom filter of the wanted ones, so only documents with a likely hit send a row at all.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stage_table

#: Longest string hashed for an anchor, in bytes.
_LONGEST = 32
#: Bytes of text hashed at a time, so that they stay in the processor's cache.
_SLICE = 1 << 16
#: Bits of the filter per wanted anchor; the filter ends at 2^26 bits (8 MB), beyond which it lets more through.
_BITS_PER_ANCHOR, _LEAST_BITS, _MOST_BITS = 16, 1 << 15, 1 << 26
_BASE = 0x9E3779B97F4A7C15


def size_class(length: np.ndarray) -> np.ndarray:
    """Bytes hashed for passages of some length: the largest power of 2 in half of it, 32 at most; 1 for one byte."""
    return np.minimum(_LONGEST, 1 << np.maximum(0, np.frexp(np.maximum(length, 1) / 2)[1] - 1))


def window(k: int) -> int:
    """Strings of a window; any passage of the class has at least so many."""
    return k if k == 1 else k + 1


def _byte_codes() -> np.ndarray:
    codes = np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)
    codes ^= codes >> np.uint64(29)
    return codes * np.uint64(0xBF58476D1CE4E5B9) | np.uint64(1)


_CODES = _byte_codes()


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every string of k bytes; k is a power of 2."""
    hashes, span = _CODES[data], 1
    while span < k:
        hashes = hashes[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + hashes[span:]
        span *= 2
    hashes = hashes ^ (hashes >> np.uint64(32))
    return hashes * np.uint64(0x94D049BB133111EB)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    left = width - span
    return np.minimum(least[: len(least) - left], least[left:]) if left else least


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes >> np.uint64(20)) & np.uint64(size - 1)


class _Filter:
    """Whether an anchor may be wanted: one bit per anchor of a class."""

    def __init__(self, wanted: DataFrame):
        counts = {r._class: r.n for r in wanted.groupBy("_class").agg(F.count("*").alias("n")).collect()}
        self.sizes = {k: int(min(_MOST_BITS, max(_LEAST_BITS, 1 << int(n * _BITS_PER_ANCHOR).bit_length()))) for k, n in counts.items()}
        self.words: dict[int, bytes] = {}
        for k, size in self.sizes.items():
            # The bit's place as the filter sees it; bitmaps of 2^15 bits are built in parallel and put next to each other.
            place = F.shiftrightunsigned("_anchor", 20).bitwiseAND(F.lit(size - 1))
            maps = wanted.filter(F.col("_class") == k).select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("at"))
            found = maps.agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << 15) - 1))).alias("map")).collect()
            filled = bytearray(size // 8)
            for at, bitmap in found:
                filled[at * 4096 : at * 4096 + len(bitmap)] = bitmap
            self.words[k] = bytes(filled)

    def may_hold(self, k: int, hashes: np.ndarray) -> np.ndarray:
        bit = _bits(hashes, self.sizes[k])
        return (np.frombuffer(self.words[k], np.uint8)[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and starts of a text column; nulls are empty."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def _passage_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = _raw(batch.column(1))
        length = np.diff(starts)
        classes = size_class(length)
        least = [gram_hashes(data[a:b], int(k)).min() if b > a else np.uint64(0) for a, b, k in zip(starts[:-1].tolist(), starts[1:].tolist(), classes, strict=True)]
        some = pa.array(length > 0)
        yield pa.record_batch([batch.column(0), pa.array(classes.astype(np.int32)), pa.array(np.array(least, np.uint64).view(np.int64))], names=["b_id", "_class", "_anchor"]).filter(some)


def _likely_anchors(wanted: _Filter):
    """Rows of document, class and anchor, each once per document and slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = _raw(batch.column(1))
            for k in wanted.sizes:
                reach = k + window(k) - 1
                for at in range(0, len(data) - reach + 1, _SLICE):
                    least = _sliding_minimum(gram_hashes(data[at : at + _SLICE + reach - 1], k), window(k))
                    place = np.flatnonzero(wanted.may_hold(k, least))
                    doc = np.searchsorted(starts, at + place, side="right") - 1
                    inside = at + place + reach <= starts[doc + 1]
                    if inside.any():
                        found = np.unique(np.stack([doc[inside], least[place[inside]].view(np.int64)]), axis=1)
                        ids = batch.column(0).take(pa.array(found[0]))
                        yield pa.record_batch([ids, pa.array(np.full(len(ids), k, np.int32)), pa.array(found[1])], names=["a_id", "_class", "_anchor"])

    return run


def candidates(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``a_id``, ``b_id`` of all documents that share the anchor of a passage, so of all that contain it; staged."""
    kinds = {side: df.schema["id"].dataType.simpleString() for side, df in (("a", docs), ("b", passages))}
    texts = passages.select("id", F.col("text").cast("string").alias("text")).filter("text <> ''")
    wanted = stage_table(texts.mapInArrow(_passage_anchors, f"b_id {kinds['b']}, _class int, _anchor long"))
    likely = docs.select("id", F.col("text").cast("string").alias("text")).mapInArrow(_likely_anchors(_Filter(wanted)), f"a_id {kinds['a']}, _class int, _anchor long")
    return stage_table(likely.join(wanted, ["_class", "_anchor"]).select("a_id", "b_id").distinct())


def containing(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``a_id``, ``b_id`` where the document's text contains the passage's, byte for byte; an empty passage is in none.

    Both tables have ``id`` and ``text``; a null text contains nothing and is in nothing. Each pair of ids is once in
    the result. Only the texts of candidates are read again, by a semi-join.
    """
    pairs = candidates(docs, passages)
    a_texts = docs.join(pairs.select(F.col("a_id").alias("id")), "id", "left_semi").select(F.col("id").alias("a_id"), F.col("text").alias("_a"))
    b_texts = passages.join(pairs.select(F.col("b_id").alias("id")), "id", "left_semi").select(F.col("id").alias("b_id"), F.col("text").alias("_b"))
    found = pairs.join(a_texts, "a_id").join(b_texts, "b_id").filter(F.contains("_a", "_b") & (F.col("_b") != ""))
    return found.select("a_id", "b_id").distinct()


# Executors may not have this package on their path, so its functions travel as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

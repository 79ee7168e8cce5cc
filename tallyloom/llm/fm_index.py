"""Benchmark passages in documents, found by backward search in one FM-index per shard.

The words of a shard, documents parted by a mark, are one sequence of numbers. Its suffixes are sorted, the word before
each suffix is kept in a wavelet tree, and a phrase is searched from its last word to its first by two ranks per word,
all phrases of a block at once. Rows of the index become places by walking back to the next sampled suffix. Hits of
overlapping windows are merged to spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

#: Phrases that are broadcast at a time; more are searched block by block.
PHRASES = 100_000
#: Bytes of text in one index.
INDEX_BYTES = 2 << 20
#: Every so many words the place of a suffix is kept.
SAMPLE = 16
#: All ASCII but digits and small letters (texts are lower-cased first).
SEPARATORS = (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes of a sequence of numbers, in order; ranks by 3, 6, 12, ... symbols of what is still tied."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.concatenate([text, np.zeros(2, text.dtype)]).astype(np.uint64)
    width = np.uint64(21)
    if int(text.max()) + 1 < 1 << 21:  # three symbols and the end of the text (0) in one number
        one = padded + np.uint64(1)
        one[n:] = 0
        key, span = (one[:n] << (width * np.uint64(2))) | (one[1 : n + 1] << width) | one[2 : n + 2], 3
    else:
        key, span = padded[:n], 1
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    slot = np.arange(n)
    while True:
        own = head[slot]
        tied = np.ones(len(slot), bool)
        tied[:] = False
        same = own[1:] == own[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        slot = slot[tied]
        if not len(slot):
            return order
        place = order[slot]
        following = np.where(place + span < n, rank[np.minimum(place + span, n - 1)], -1)
        by = np.lexsort((following, head[slot]))
        place, following, group = place[by], following[by], head[slot]
        order[slot] = place
        split = np.ones(len(slot), bool)
        split[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        head[slot] = np.maximum.accumulate(np.where(split, slot, 0))
        rank[place] = head[slot]
        span *= 2


class WaveletTree:
    """Ranks of numbers in a sequence: per bit from the highest on, the counts of zeros and the stable partition by that bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((bit, zeros))
            values = np.concatenate([values[~one], values[one]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        low, high = np.zeros(len(ends), np.int64), ends.astype(np.int64)
        for bit, zeros in self.levels:
            one = (symbols >> bit) & 1 == 1
            total = int(zeros[-1])
            low = np.where(one, total + low - zeros[low], zeros[low])
            high = np.where(one, total + high - zeros[high], zeros[high])
        return high - low


class FMIndex:
    """Index of a sequence of numbers from 0 to ``top``; inside, all are one higher and a single 0 ends the sequence."""

    def __init__(self, text: np.ndarray, top: int):
        text = np.append(text + 1, 0)
        order = suffix_order(text)
        self.before = text[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 2))])
        self.tree = WaveletTree(self.before, int(top + 1).bit_length())
        self.sampled = order % SAMPLE == 0
        self.place = np.where(self.sampled, order, 0)

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``low .. high`` of each phrase; symbols are right-aligned in ``phrases``."""
        phrases = phrases + 1
        last = phrases[:, -1]
        low, high = self.starts[last], self.starts[last + 1]
        for back in range(2, phrases.shape[1] + 1):
            go = np.flatnonzero((length >= back) & (low < high))
            if not len(go):
                break
            symbol = phrases[go, -back]
            low[go] = self.starts[symbol] + self.tree.rank(symbol, low[go])
            high[go] = self.starts[symbol] + self.tree.rank(symbol, high[go])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            symbol = self.before[rows[walking]]
            rows[walking] = self.starts[symbol] + self.tree.rank(symbol, rows[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.place[rows] + steps


def _words(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buffer = C.lower_table()[buffer]
    starts, ends = C.words_of(buffer, SEPARATORS)
    return starts, ends, C.run_hashes(buffer, starts, ends), C.firsts_of(starts, offsets)


def _phrase_rows(window: int):
    """Windows of the items, as right-aligned word hashes."""
    fields = C.pa_schema("item_id long, length int, words binary")

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = np.frombuffer((text or "").encode() + b"\xff", np.uint8)
                hashes = _words(raw, np.array([0, len(raw)]))[2]
                if item is None or not len(hashes):
                    continue
                length = min(window, len(hashes))
                rows = np.lib.stride_tricks.sliding_window_view(hashes, length)
                yield C.record_batch({"item_id": [item] * len(rows), "length": [length] * len(rows), "words": [r.tobytes() for r in rows]}, fields)

    return run


def _hits(shard: C.Shard, items: np.ndarray, length: np.ndarray, phrases: np.ndarray):
    """Per occurrence: place, number of words, item; and the words and firsts of the shard.

    Places count a mark after each document, so occurrences in two documents never touch.
    """
    starts, ends, hashes, firsts = _words(shard.buffer, shard.offsets)
    none = np.zeros(0, np.int64)
    vocabulary = np.unique(hashes)
    inside = np.arange(phrases.shape[1]) >= phrases.shape[1] - length[:, None]
    possible = (C.in_sorted(phrases.ravel(), vocabulary).reshape(phrases.shape) | ~inside).all(1)
    if not possible.any():
        return starts, ends, firsts, none, none, none
    items, length, phrases, inside = items[possible], length[possible], phrases[possible], inside[possible]
    # Symbols from 1; 0 parts the documents.
    words = np.searchsorted(vocabulary, hashes) + 1
    doc = np.repeat(np.arange(shard.n), np.diff(firsts))
    text = np.zeros(len(words) + shard.n, np.int64)
    text[np.arange(len(words)) + doc] = words
    index = FMIndex(text, len(vocabulary))
    symbols = np.where(inside, np.minimum(np.searchsorted(vocabulary, phrases), len(vocabulary) - 1) + 1, 0)
    low, high = index.search(symbols, length)
    count = high - low
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return starts, ends, firsts, index.locate(rows), np.repeat(length, count), np.repeat(items, count)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, shards: DataFrame | None = None) -> DataFrame:
    """``ref, doc_id, n_words, n_hit, items, starts, ends`` for every row of ``docs``.

    Words are runs of digits, letters a to z (A-Z lower-cased) and bytes beyond ASCII. Searched are all windows of
    ``window`` consecutive words of each ``benchmark`` row (``item_id, text``), or all its words if it has fewer; rows
    without words or without an id have none, and rows with one id are one item. ``n_hit`` counts the words of the
    document inside any occurrence, ``items`` are the ids found, in order of their strings, and ``starts`` and ``ends``
    (longs) the byte spans from the first to the last word of each maximal run of hits. Null and empty texts have no
    words. Rows with equal ids are separate documents. More columns are ignored.
    """
    spark = docs.sparkSession
    shards = C.shards_of(docs, INDEX_BYTES) if shards is None else shards
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    phrases = C.staged(items.mapInArrow(_phrase_rows(window), "item_id long, length int, words binary").distinct())
    blocks = max(1, -(-phrases.count() // PHRASES))
    found = None
    for block in range(blocks):
        rows = phrases.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block).collect()  # bounded: PHRASES as a mean
        words = np.zeros((len(rows), window), np.uint64)
        for i, r in enumerate(rows):
            words[i, window - r["length"] :] = np.frombuffer(r["words"], np.uint64)
        sent = spark.sparkContext.broadcast((np.array([r["item_id"] for r in rows], np.int64), np.array([r["length"] for r in rows], np.int64), words))
        more = C.map_shards(shards, _find(sent), "ref long, doc_id long, n_words long, firsts binary, lasts binary, items binary, starts binary, ends binary")
        found = more if found is None else found.unionByName(more)
    merged = found.groupBy("ref").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list(F.struct("firsts", "lasts", "items", "starts", "ends")).alias("hits"))
    return merged.mapInArrow(_merge, "ref long, doc_id long, n_words long, n_hit long, items binary, starts binary, ends binary")


def _find(sent):
    def make(shard: C.Shard) -> Iterator[dict]:
        starts, ends, firsts, place, length, items = _hits(shard, *sent.value)
        order = np.argsort(place, kind="stable")
        place, length, items = place[order], length[order], items[order]
        heads = firsts + np.arange(shard.n + 1)  # places of the first words
        first, last = C.merge_spans(place, place + length)
        at, ends_at = np.searchsorted(first, heads), np.searchsorted(place, heads)
        doc = np.searchsorted(heads, first, side="right") - 1
        first, last = first - doc, last - doc
        out = {name: [] for name in ("firsts", "lasts", "items", "starts", "ends")}
        for i in range(shard.n):
            a, b = first[at[i] : at[i + 1]], last[at[i] : at[i + 1]]
            out["firsts"].append((a - firsts[i]).tobytes())
            out["lasts"].append((b - firsts[i]).tobytes())
            out["starts"].append((starts[a] - shard.offsets[i]).tobytes())
            out["ends"].append((ends[b - 1] - shard.offsets[i]).tobytes())
            out["items"].append(np.unique(items[ends_at[i] : ends_at[i + 1]]).tobytes())
        yield {"ref": (shard.shard << 20) + np.arange(shard.n), "doc_id": C.id_array(shard), "n_words": np.diff(firsts)} | out

    return make


def _merge(batches):
    fields = C.pa_schema("ref long, doc_id long, n_words long, n_hit long, items binary, starts binary, ends binary")
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            blocks = {name: np.concatenate([np.frombuffer(h[name], np.int64) for h in row["hits"]]) for name in ("firsts", "lasts", "items", "starts", "ends")}
            first, last = C.merge_spans(blocks["firsts"], blocks["lasts"])
            a, b = C.merge_spans(blocks["starts"], blocks["ends"])
            out.append((row["ref"], row["doc_id"], row["n_words"], int((last - first).sum()), np.unique(blocks["items"]).tobytes(), a.tobytes(), b.tobytes()))
        if out:
            yield C.record_batch(dict(zip(fields.names, zip(*out, strict=True), strict=True)), fields)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``; see :func:`benchmark_hits`."""
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    fields = C.pa_schema(schema)

    def digest(batches):
        for batch in batches:
            out = batch.select(["doc_id", "n_words", "n_hit"]).to_pydict()
            items = [np.frombuffer(x, np.int64) for x in batch.column("items").to_pylist()]
            out["n_items"] = [len(x) for x in items]
            out["items_sha256"] = [hashlib.sha256(",".join(sorted(map(str, x.tolist()))).encode()).hexdigest() for x in items]
            out["contaminated"] = [n > 0 for n in out["n_hit"]]
            yield C.record_batch(out, fields)

    found = benchmark_hits(docs, benchmark, window).select("doc_id", "n_words", "n_hit", "items")
    return found.mapInArrow(digest, schema)


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with the merged spans of all hits cut out of their texts; see :func:`benchmark_hits`.

    All rows and columns stay; ``n_chars``, if there, counts the new text. A null text stays null.
    """
    shards = C.shards_of(docs, INDEX_BYTES, carry=True)
    hits = benchmark_hits(docs, benchmark, window, shards).filter("n_hit > 0")
    by_shard = hits.groupBy(F.shiftright("ref", 20).alias("shard")).agg(F.collect_list(F.struct("ref", "starts", "ends")).alias("hits"))

    def texts(shard, hits):
        spans = [(shard.offsets[h["ref"] & 0xFFFFF], np.frombuffer(h["starts"], np.int64), np.frombuffer(h["ends"], np.int64)) for h in hits or ()]
        none = [np.zeros(0, np.int64)]
        return C.cut_texts(shard, np.concatenate(none + [at + a for at, a, _ in spans]), np.concatenate(none + [at + b for at, _, b in spans]))

    return C.whole_rows(shards.join(by_shard, "shard", "left"), docs.schema, texts, "hits")

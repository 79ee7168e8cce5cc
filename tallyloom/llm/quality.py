"""Quality rules: base rules on counts, and gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents, with monotonic constraints on chosen statistics, and
flattened into arrays of nodes, so a batch of documents goes down all trees by array lookups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

#: Labelled documents that the trees are fitted on, at most; those with the smallest hash of their id.
SAMPLE = 20_000
ROUNDS, DEPTH, RATE, BINS, RIDGE = 60, 3, 0.2, 64, 5.0
#: A document goes if the trees give it less than this probability of good quality.
KEEP_FROM = 0.25
WINDOW = 5
#: Bytes of text measured at a time.
SLICE_BYTES = 2 << 20

SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "log_words", "word_length", "symbols", "duplicate_lines", "repeated_words", "capitals", "digits", "marks",
    "beyond_ascii", "distinct_words", "line_words", "longest_word", "stops",
)
#: More of these never makes a document better (-1).
MONOTONIC = {"symbols": -1, "duplicate_lines": -1, "repeated_words": -1}


def _class(members) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    return table


_CAPITALS, _DIGITS = _class(range(65, 91)), _class(range(48, 58))
_SYMBOLS, _MARKS = _class(SYMBOLS), _class(b"!?;:()[]{}@~^_=+/\\\"")
_CONTINUED, _LEAD, _STOPS = _class(range(0x80, 0xC0)), _class(range(0xC0, 0xFF)), _class(b".")


def statistics(shard: C.Shard) -> dict[str, np.ndarray]:
    """Counts per document, and ``features`` as one row per document."""
    buffer, offsets, n = shard.buffer, shard.offsets, shard.n
    heads = offsets[:-1]

    def total(table):
        return np.add.reduceat(table[buffer], heads) if n else np.zeros(0, np.int64)

    starts, ends = C.words_of(buffer)
    firsts = C.firsts_of(starts, offsets)
    n_words = np.diff(firsts)
    doc = np.repeat(np.arange(n), n_words)
    # Code points of a word: its bytes without the continuing ones; no white space is a continuing byte.
    continued = np.concatenate([[0], np.cumsum(_CONTINUED[buffer])])
    length = (ends - starts) - (continued[ends] - continued[starts])
    word_chars = np.bincount(doc, length, n).astype(np.int64)
    hashes = C.run_hashes(buffer, starts, ends)

    lines, line_ends = C.words_of(buffer, (0x0A,))
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, lines)
    lines, line_ends = lines[worded], line_ends[worded]
    line_doc = np.searchsorted(offsets, lines, side="right") - 1
    n_lines = np.bincount(line_doc, minlength=n)
    n_dup_lines = n_lines - _distinct(line_doc, C.run_hashes(buffer, lines, line_ends), n)

    grams = C.shingle_hashes(hashes, WINDOW)
    at = np.flatnonzero(C.valid_starts(firsts, WINDOW, len(grams)))
    key = _by_document(doc[at], grams[at])
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    repeated = C.covered(len(starts), at[twice], at[twice] + WINDOW)
    n_repeat_words = np.bincount(doc, repeated, n).astype(np.int64)

    words, chars = np.maximum(n_words, 1), np.maximum(offsets[1:] - heads - 1 - total(_CONTINUED), 1)
    n_symbols = total(_SYMBOLS)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    features = np.stack([
        np.log1p(n_words), word_chars / words, n_symbols / chars, n_dup_lines / np.maximum(n_lines, 1), n_repeat_words / words,
        total(_CAPITALS) / chars, total(_DIGITS) / chars, total(_MARKS) / chars, total(_LEAD) / chars,
        _distinct(doc, hashes, n) / words, n_words / np.maximum(n_lines, 1), longest, total(_STOPS) / words,
    ], 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words, "base_failed": (n_words < 10) | (100 * n_repeat_words > 20 * n_words), "features": features,
    }


def _by_document(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return C.mix(hashes ^ C.mix(doc.astype(np.uint64) + np.uint64(1)))


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    key = _by_document(doc, hashes)
    _, first = np.unique(key, return_index=True)
    return np.bincount(doc[first], minlength=n)


# Trees --------------------------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """Complete binary trees, node i with children 2i+1 and 2i+2; ``value`` of the leaves of each tree."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Probability of good quality: to the right where the statistic is above the threshold."""
        score, depth = np.full(len(rows), self.base), int(self.value.shape[1]).bit_length() - 1
        every = np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            score += value[node - len(feature)]
        return 1 / (1 + np.exp(-score))


def fit(rows: np.ndarray, good: np.ndarray, signs: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees:
    """Boost trees on the logistic loss; ``signs`` per statistic: 1 never falls, -1 never rises, 0 free.

    A split on a constrained statistic whose children are in the wrong order is not made, and both children stay on
    their sides of the middle of their values all the way down, so the whole function is monotonic.
    """
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], 1)
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score, nodes = np.full(len(rows), base), 2**depth - 1
    out = ([], [], [])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = good - p, p * (1 - p)
        feature, threshold, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes + 1)
        place = np.zeros(len(rows), np.int64)
        limits = {0: (-np.inf, np.inf)}
        for node in range(nodes):
            low, high = limits[node]
            here = np.flatnonzero(place == node)
            best = (1e-6, None)
            for j, e in enumerate(edges):
                if not len(e) or len(here) < 20:
                    continue
                g = np.cumsum(np.bincount(binned[here, j], gradient[here], len(e) + 1))
                h = np.cumsum(np.bincount(binned[here, j], weight[here], len(e) + 1))
                gl, hl, gr, hr = g[:-1], h[:-1], g[-1] - g[:-1], h[-1] - h[:-1]
                left, right = np.clip(gl / (hl + RIDGE), low, high), np.clip(gr / (hr + RIDGE), low, high)
                gain = _gain(gl, hl, left) + _gain(gr, hr, right) - _gain(g[-1], h[-1], np.clip(g[-1] / (h[-1] + RIDGE), low, high))
                gain[(signs[j] * (right - left) < 0) | (hl < 1) | (hr < 1)] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (gain[k], (j, k, left[k], right[k]))
            right_limits, left_limits = (low, high), (low, high)
            if best[1] is not None:
                j, k, left, right = best[1]
                feature[node], threshold[node] = j, edges[j][k]
                if signs[j]:
                    middle = (left + right) / 2
                    left_limits, right_limits = ((low, middle), (middle, high)) if signs[j] > 0 else ((middle, high), (low, middle))
            limits[2 * node + 1], limits[2 * node + 2] = left_limits, right_limits
            place[here] = 2 * node + 1 + (rows[here, feature[node]] > threshold[node])
        for leaf in range(nodes + 1):
            here = place == nodes + leaf
            value[leaf] = RATE * np.clip(gradient[here].sum() / (weight[here].sum() + RIDGE), *limits[nodes + leaf]) if here.any() else 0.0
        score += value[place - nodes]
        for column, x in zip(out, (feature, threshold, value), strict=True):
            column.append(x)
    return Trees(*map(np.array, out), base)


def _gain(g, h, value):
    return 2 * g * value - (h + RIDGE) * value**2


# The operator -------------------------------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees fitted on at most ``sample`` labelled documents; none if only one or no kind of label is there.

    ``labels`` is ``doc_id, quality`` (1 good, 0 bad; null labels and ids are left out, of several labels of one
    document the smallest counts).
    """
    C.limit_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    schema = ", ".join(f"{name} double" for name in FEATURES) + ", good double"
    fields = C.pa_schema(schema)

    def measure(batches):
        for batch in batches:
            for start, end in _slices(batch.column(0)):
                part = batch.slice(start, end - start)
                found = statistics(C.loose_shard([x and x.encode() for x in part.column(0).to_pylist()]))["features"]
                yield C.record_batch(dict(zip(FEATURES, found.T, strict=True)) | {"good": np.array(part.column(1).to_pylist(), float)}, fields)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    once = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])  # however often an id is repeated
    rows = once.select("text", "quality").mapInArrow(measure, schema).collect()  # ``sample`` rows
    data = np.array(rows, float).reshape(-1, len(FEATURES) + 1)
    data = data[np.lexsort(data.T)]  # the same model whatever the order of rows
    good = data[:, -1]
    if not len(data) or good.min() == good.max():
        return None
    signs = np.array([MONOTONIC.get(name, 0) for name in FEATURES])
    return fit(data[:, :-1], good, signs)


def _slices(texts, limit: int = SLICE_BYTES):
    """Starts and ends of runs of texts that together have about ``limit`` bytes; a longer text is a run of its own."""
    start = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and size + length > limit:
            yield start, i
            start, size = i, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


def _judge(texts: list[str | None], trees: Trees | None) -> dict[str, np.ndarray]:
    found = statistics(C.loose_shard([x and x.encode() for x in texts]))
    features = found.pop("features")
    found["score"] = trees.probability(features) if trees else np.ones(len(features))
    found["kept"] = ~found["base_failed"] & (found["score"] >= KEEP_FROM)
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score`` for every row.

    Null and empty texts have no words and fail. Rows with equal ids are judged each by itself. Without labels of both
    kinds only the base rules decide.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    fields = C.pa_schema(schema)

    def run(batches):
        for batch in batches:
            for start, end in _slices(batch.column(1)):
                part = batch.slice(start, end - start)
                yield C.record_batch({"doc_id": part.column(0)} | _judge(part.column(1).to_pylist(), sent.value), fields)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for start, end in _slices(batch.column(place)):
                part = batch.slice(start, end - start)
                yield part.filter(pa.array(_judge(part.column(place).to_pylist(), sent.value)["kept"]))
        C.give_back()

    return docs.mapInArrow(run, docs.schema)

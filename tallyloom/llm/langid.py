"""Language of a text by a string kernel with Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1 to 4, blended) present in both, normalised by the
numbers present in each. Some training texts are landmarks; the kernels of a text with all of them, whitened by the
landmarks' own kernel matrix, are its features, and one ridge regression per language against the rest scores them.
All n-grams count. Scores are linear in the n-grams present, so a model is one weight per language and n-gram of a
landmark; other n-grams only add to the number that a text is normalised by.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

#: Training texts per language, at most, and how many of them are landmarks.
PER_LANGUAGE, LANDMARKS = 400, 32
#: n-grams are told apart by a hash of 20 bits.
HASH_BITS, LONGEST = 20, 4
RIDGE, SHARPNESS = 1e-2, 6.0
UNKNOWN = "und"
_ROWS, _CHARS, _GATHER = 256, 1 << 20, 4096
_LETTER = re.compile(r"[^\W\d_]")


def gram_hashes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and hash of each n-gram of the lower-cased texts, in pieces of bounded size."""

    def pieces():
        numbers, parts, size = [], [], 0
        for i, text in enumerate(texts):
            text = text.lower()
            for at in range(0, max(1, len(text) - LONGEST + 1), _CHARS):  # pieces of a long text overlap
                part = text[at : at + _CHARS + LONGEST - 1]
                numbers.append(i)
                parts.append(part)
                size += len(part)
                if size > _CHARS:
                    yield numbers, parts
                    numbers, parts, size = [], [], 0
        if parts:
            yield numbers, parts

    for numbers, parts in pieces():
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        text = np.repeat(numbers, [len(p) for p in parts])
        part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        rolled = np.zeros(len(code), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(code) < n:
                break
            rolled = rolled[: len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
            inside = part[: len(rolled)] == part[n - 1 :]
            hashed = (rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)
            yield text[: len(rolled)][inside], hashed[inside].astype(np.int64)


def grams_of(text: str) -> np.ndarray:
    """The hashes present in a text, ascending."""
    seen = np.zeros(1 << HASH_BITS, bool)
    for _, hashed in gram_hashes([text]):
        seen[hashed] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """``number`` of each hash among the n-grams of the landmarks (-1: in none), their weights per language."""

    languages: list[str]
    number: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        """One score per text and language, about -1 to 1."""
        found = np.zeros((len(texts), len(self.languages)))
        for row, text in zip(found, texts, strict=True):
            grams = grams_of(text)
            gram = self.number[grams]
            row[:] = self.weights[gram[gram >= 0]].sum(0, dtype=float) / np.sqrt(max(len(grams), 1))
        return found + self.offset


def kernel_rows(texts: list[str], number: np.ndarray) -> np.ndarray:
    """Presence of the n-grams with a number, scaled so that products of rows are normalised kernels.

    The kernel written out, for few n-grams; models use :func:`kernels`.
    """
    rows = np.zeros((len(texts), int(number.max()) + 1), np.float32)
    for text, hashed in gram_hashes(texts):
        gram = number[hashed]
        known = gram >= 0
        rows[text[known], gram[known]] = 1
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


def kernels(present: list[np.ndarray], landmarks: list[np.ndarray], number: np.ndarray) -> np.ndarray:
    """Normalised kernels of texts, given by the hashes present, with the landmarks, whose n-grams have numbers."""
    gram = number[np.concatenate(landmarks)]
    order = np.argsort(gram, kind="stable")
    holder = np.repeat(np.arange(len(landmarks)), [len(x) for x in landmarks])[order]  # of each n-gram in turn
    firsts = np.searchsorted(gram[order], np.arange(int(number.max()) + 2))
    size = np.sqrt([max(len(x), 1) for x in landmarks])
    result = np.zeros((len(present), len(landmarks)))
    for row, found in zip(result, present, strict=True):
        own = number[found]
        own = own[own >= 0]
        for at in range(0, len(own), _GATHER):
            first = firsts[own[at : at + _GATHER]]
            length = firsts[own[at : at + _GATHER] + 1] - first
            places = np.arange(length.sum()) + np.repeat(first - np.cumsum(length) + length, length)
            row += np.bincount(holder[places], minlength=len(landmarks))
        row /= size * np.sqrt(max(len(found), 1))
    return result


def fit(languages: list[str], present: list[np.ndarray]) -> Model | None:
    """Fit on the hashes present in each training text, given with its language."""
    names = sorted(set(languages))
    if not names:
        return None
    label = np.array([names.index(x) for x in languages])
    chosen = np.concatenate([np.flatnonzero(label == j)[:LANDMARKS] for j in range(len(names))])
    landmarks = [present[i] for i in chosen]
    counted = np.unique(np.concatenate(landmarks))
    if not len(counted):
        return None
    number = np.full(1 << HASH_BITS, -1, np.int32)
    number[counted] = np.arange(len(counted))
    # Features: kernels with the landmarks times the inverse root of the landmarks' own kernel matrix.
    kernel = kernels(present, landmarks, number)
    values, vectors = np.linalg.eigh(kernel[chosen])
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max())) @ vectors.T
    features = kernel @ root
    mean = features.mean(0)
    target = np.where(label[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Every language weighs the same, however many texts it has.
    weight = 1 / np.bincount(label)[label]
    center = features - mean
    solved = np.linalg.solve(center.T @ (center * weight[:, None]) + RIDGE * np.eye(len(root)), center.T @ ((target - target.mean(0)) * weight[:, None]))
    weights = np.zeros((len(counted), len(names)))
    for found, own in zip(landmarks, root @ solved, strict=True):
        weights[number[found]] += own / np.sqrt(max(len(found), 1))
    return Model(names, number, weights.astype(np.float32), target.mean(0) - mean @ solved)


def train(labelled: DataFrame) -> Model | None:
    """A model of at most ``PER_LANGUAGE`` texts of each language in ``labelled`` (``doc_id, text, lang``).

    The sample takes the smallest id in each of as many buckets of ids; the counts of n-grams come to the driver only
    for it.
    """
    C.limit_batches(labelled.sparkSession)
    buckets = F.pmod(F.xxhash64("doc_id"), F.lit(PER_LANGUAGE))
    sample = labelled.groupBy("lang", buckets.alias("_bucket")).agg(F.min("doc_id").alias("doc_id")).select("lang", "doc_id")
    fields = C.pa_schema("lang string, doc_id long, grams binary")

    def present(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield C.record_batch({"lang": [row["lang"]], "doc_id": [row["doc_id"]], "grams": [grams_of(row["text"]).astype(np.int32).tobytes()]}, fields)

    chosen = labelled.join(F.broadcast(sample), ["lang", "doc_id"]).dropDuplicates(["lang", "doc_id"])  # one row per id
    rows = chosen.mapInArrow(present, "lang string, doc_id long, grams binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], r["grams"]))
    return fit([r["lang"] for r in rows], [np.frombuffer(r["grams"], np.int32) for r in rows])


def identify(docs: DataFrame, folds: int = 4, chosen: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (``doc_id, text, lang``).

    Learns only from rows with a language whose crc32 of the id, as text, modulo ``folds`` is not ``chosen``; rows with
    a null id or text are not learned from, and their ``held_out`` is false. A text that is null or has no letter is
    ``und`` with score 0, as is every text if there is nothing to learn from. Otherwise ``score`` is between 0 and 1,
    the share of the predicted language. Ties go to the first language by name. Whole texts count, however long.
    """
    spark = docs.sparkSession
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sent = spark.sparkContext.broadcast(train(own.filter((remainder != chosen) & F.col("lang").isNotNull() & F.col("text").isNotNull())))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    fields = C.pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                texts = batch.column(2).to_pylist()
                usable = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
                names, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if model and usable:
                    found = model.score([texts[i] for i in usable])
                    share = np.exp(SHARPNESS * (found - found.max(1, keepdims=True)))
                    share /= share.sum(1, keepdims=True)
                    for i, best, s in zip(usable, found.argmax(1).tolist(), share, strict=True):
                        names[i], score[i] = model.languages[best], float(s[best])
                yield C.record_batch({"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": names, "score": score}, fields)

    return own.select("doc_id", F.coalesce(remainder == chosen, F.lit(False)).alias("held_out"), "text").mapInArrow(run, schema)

"""Byte-level BPE encoding and decoding with a queue of merge ranks kept as a hierarchical bitmap.

The tokens of a pre-token are a linked list over the places of their first bytes; a bucket per merge rank holds the
places whose pair has that rank, a bitmap of two levels finds the next rank, and places whose pair has changed since
are skipped. Long pre-tokens have a queue each. Short ones, of which a worker meets hundreds of thousands, share one:
their lists lie one after the other, and a bucket is merged for all of them at once.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

#: Pre-tokens remembered by a Python worker before it starts anew.
MEMO = 400_000
#: Longer pre-tokens, in bytes, have a queue of their own.
SHORT = 128
#: Bytes of text encoded at a time.
GROUP = 4 << 20


class RankQueue:
    """Places by rank. A set bit of ``words`` is a non-empty bucket; a set bit of ``top`` is a word that is not zero.

    Taking the first rank is one find-first-set in each of the two levels, whatever the number of places.
    """

    __slots__ = ("buckets", "top", "words")

    def __init__(self, buckets: dict[int, list[int]]):
        """Start with whole buckets, places ascending."""
        self.buckets, self.words, self.top = buckets, {}, 0
        words = self.words
        for rank in buckets:
            high = rank >> 8
            words[high] = words.get(high, 0) | 1 << (rank & 255)
            self.top |= 1 << high

    def add(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, place)
            return
        self.buckets[rank] = [place]
        high = rank >> 8
        self.words[high] = self.words.get(high, 0) | 1 << (rank & 255)
        self.top |= 1 << high

    def put(self, rank: int, places: list[int]) -> None:
        """Put a whole bucket back."""
        self.add(rank, places[0])
        self.buckets[rank] += places[1:]

    def take_all(self) -> tuple[int, list[int]]:
        """Remove the bucket of the smallest rank."""
        high = (self.top & -self.top).bit_length() - 1
        word = self.words[high]
        rank = high << 8 | (word & -word).bit_length() - 1
        self._clear(high, word)
        return rank, self.buckets.pop(rank)

    def _clear(self, high: int, word: int) -> None:
        word &= word - 1
        self.words[high] = word
        if not word:
            self.top &= self.top - 1

    def take(self) -> tuple[int, int]:
        """Remove the first place of the smallest rank."""
        top = self.top
        high = (top & -top).bit_length() - 1
        word = self.words[high]
        rank = high << 8 | (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        self._clear(high, word)
        return rank, bucket[0]


class BytePairs:
    """Encoder and decoder for a table of byte strings and their ranks; every single byte must be in it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.strings = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        top = max(self.strings) + 1
        self.length = np.zeros(top, np.int64)
        self.length[list(self.strings)] = [len(t) for t in self.strings.values()]
        self.heads = np.concatenate([[0], np.cumsum(self.length)])
        self.letters = np.frombuffer(b"".join(self.strings.get(r, b"") for r in range(top)), np.uint8)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(list(pairs), np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(list(pairs.values()), np.int64)[order], -1)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they don't merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, and for each pre-token where its own begin in them and how many they are."""
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        size = np.array([len(p) for p in pieces], np.int64)
        single = np.flatnonzero(whole >= 0)
        long = np.flatnonzero((whole < 0) & (size > SHORT))
        short = np.flatnonzero((whole < 0) & (size <= SHORT) & (size > 0))
        own = [self.encode(pieces[i]) for i in long.tolist()]
        merged, n_short = self._merge_together([pieces[i] for i in short.tolist()])
        counts, heads = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        counts[single], counts[short], counts[long] = 1, n_short, [len(x) for x in own]
        order = np.concatenate([single, short, long])
        heads[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate([whole[single], merged, *(np.array(x, np.int64) for x in own)]), heads, counts

    def _merge_together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode` for many pre-tokens; of one rank, each merges its leftmost place before the queue is asked again."""
        text = np.frombuffer(b"".join(pieces), np.uint8)
        n, size = len(text), np.array([len(p) for p in pieces], np.int64)
        if not n:
            return np.zeros(0, np.int64), size
        piece = np.repeat(np.arange(len(pieces)), size)
        token = np.append(self.bytes[text], 0)
        ends = np.cumsum(size)
        after, before = np.arange(1, n + 1), np.arange(-1, n)
        after[ends - 1], before[ends - size], before[n] = n, -1, -1  # n: no token follows
        pair = np.where(after < n, self.pair_ranks(token[:n], token[after]), -1)
        alive = np.ones(n, bool)
        order = np.argsort(pair, kind="stable")
        order = order[np.searchsorted(pair[order], 0) :]
        cuts = np.flatnonzero(np.diff(pair[order])) + 1
        queue = RankQueue({int(pair[part[0]]): part.tolist() for part in np.split(order, cuts) if len(part)})
        while queue.top:
            rank, places = queue.take_all()
            at = np.array(places)
            if len(at) > 1:
                at.sort()
            at = at[pair[at] == rank]
            if not len(at):
                continue
            if len(at) > 1:
                own = piece[at]
                first = np.ones(len(at), bool)
                first[1:] = own[1:] != own[:-1]
                if not first.all():
                    queue.put(rank, at[~first].tolist())
                    at = at[first]
            gone = after[at]
            end = after[gone]
            token[at], after[at], pair[gone], alive[gone] = rank, end, -1, False
            inside = end < n
            before[end[inside]] = at[inside]
            new = np.where(inside, self.pair_ranks(token[at], token[end]), -1)
            pair[at] = new
            left = before[at]
            prior = left >= 0
            left = left[prior]
            newer = self.pair_ranks(token[left], token[at[prior]])
            pair[left] = newer
            for r, i in zip(new.tolist(), at.tolist(), strict=True):
                if r >= 0:
                    queue.add(r, i)
            for r, i in zip(newer.tolist(), left.tolist(), strict=True):
                if r >= 0:
                    queue.add(r, i)
        return token[:n][alive], np.bincount(piece[alive], minlength=len(pieces))

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one pre-token: again and again the leftmost pair of the smallest rank is merged.

        Tokens are a linked list over the places of their first bytes. A queued pair is stale if its place was merged
        away or has another pair by now; it is skipped when it is taken.
        """
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair: list[int] = [-1] * n  # rank of the pair that starts here, -1: none
        first: dict[int, list[int]] = {}
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                first.setdefault(rank, []).append(i)
        queue = RankQueue(first)
        while queue.top:
            rank, i = queue.take()
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[gone]
            after[i], pair[gone] = end, -1
            if end < n:
                before[end] = i
                new = ranks.get(piece[i : after[end]])
                pair[i] = -1 if new is None else new
                if new is not None:
                    queue.add(new, i)
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                new = ranks.get(piece[left:end])
                pair[left] = -1 if new is None else new
                if new is not None:
                    queue.add(new, left)
        tokens, i = [], 0
        while i < n:
            tokens.append(ranks[piece[i : after[i]]])
            i = after[i]
        return tokens

    def decode(self, tokens: np.ndarray) -> bytes:
        return gather(self.letters, self.heads[tokens], self.length[tokens]).tobytes()


def gather(values: np.ndarray, heads: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``heads``, one after the other."""
    return values[np.repeat(heads - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: per line a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Tokenizer:
    """Encodes whole texts. Known pre-tokens have numbers; their tokens lie one after the other in growing arrays."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pairs = BytePairs(ranks)
        self.split = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.tokens, self.heads, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The tokens of each text."""
        if len(self.number) > MEMO:
            self.forget()
        number, known = self.number, len(self.number)
        texts = [np.array([number.setdefault(p, len(number)) for p in self.split(text)], np.int64) for text in texts]
        fresh = [p.encode() for p, i in zip(reversed(number), range(len(number), known, -1), strict=False)][::-1]
        tokens, heads, counts = self.pairs.encode_many(fresh)
        self.heads = np.concatenate([self.heads, len(self.tokens) + heads])
        self.tokens, self.counts = np.concatenate([self.tokens, tokens]), np.concatenate([self.counts, counts])
        for pieces in texts:
            yield gather(self.tokens, self.heads[pieces], self.counts[pieces])


@lru_cache(maxsize=2)
def worker_tokenizer(data: bytes, pattern: str) -> Tokenizer:
    return Tokenizer(read_ranks(data), pattern)


def encode_documents(docs: DataFrame, rank_file: str, pattern: str, make: Callable, schema: str) -> DataFrame:
    """Encode each whole text; ``make(tokenizer, doc_id, tokens)`` returns the values of ``schema``.

    The rank file, a fixed file of a few MB, is read on the driver and broadcast. Null texts are empty.
    """
    spark = docs.sparkSession
    C.limit_batches(spark)
    data = bytes(spark.read.format("binaryFile").load(_uri(rank_file)).select("content").first()[0])
    sent, fields = spark.sparkContext.broadcast(data), C.pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(sent.value, pattern)

        def encoded(ids, texts):
            out = [make(tokenizer, i, tokens) for i, tokens in zip(ids, tokenizer.encode_texts(texts), strict=True)]
            return C.record_batch(dict(zip(fields.names, zip(*out, strict=True), strict=True)), fields)

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= GROUP:
                    yield encoded(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield encoded(ids, texts)
        tokenizer.forget()  # an idle worker holds no more than the table
        C.give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _uri(path: str) -> str:
    return f"file://{path}" if path.startswith("/") else path


def _joined(tokens: np.ndarray) -> str:
    return " ".join(map(str, tokens.tolist()))


def round_trips(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``: encoded, then decoded from the ids.

    Each match of ``pattern`` is encoded by itself, without special tokens. A null text is empty and has no tokens; a
    null id stays null; rows with equal ids are separate; more columns are ignored.
    """

    def make(tokenizer, doc_id, tokens):
        return doc_id, len(tokens), C.sha256(_joined(tokens).encode()), C.sha256(tokenizer.pairs.decode(tokens))

    return encode_documents(docs, rank_file, pattern, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, tokens`` with the ids joined by one space; see :func:`round_trips`."""
    return encode_documents(docs, rank_file, pattern, lambda _, doc_id, tokens: (doc_id, len(tokens), _joined(tokens)), "doc_id long, n_tokens long, tokens string")

"""Removal of byte strings that occur twice, found in suffix arrays built by two-stage sorting.

A suffix array of the whole corpus in one place is out of reach, so only the neighbourhoods that can hold a repeat meet,
and nothing that could be one is lost:

1. Anchors: in each window of ``length`` bytes the positions whose 32-byte gram has the smallest hash. Equal windows
   have anchors at equal places, so two copies of a string share an anchor. Anchors whose gram occurs once are done.
2. The *piece* of an anchor is all that any window around it can cover. Where the pieces of two anchors are equal, all
   their windows are repeats and no byte needs to be compared.
3. Pieces that differ share a window only if they agree on one of four contexts around the anchor (see ``_contexts``).
   One representative of each such piece goes to the home of its gram, the first document that has the gram. Texts
   that are copies of each other in part share most homes, so their pieces travel as whole segments.
4. In a home the segments are sorted: the suffixes that are smaller than their successors directly, all others by scans
   over the buckets; adjacent suffixes with a common prefix of ``length`` bytes at different places are repeats.
   Homes beyond a bound are not sorted; there all windows are counted by their hash in a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

GRAM = 32
#: Bytes of segments sorted at a time, as a mean.
SORT_BYTES = 1 << 18
#: Bytes of one home that are sorted together; beyond it windows are counted by hash.
SORT_LIMIT = 8 << 20
#: Bytes whose grams are hashed at a time, so that they stay in the processor's cache.
BLOCK = 1 << 16
_CONTEXTS = 4
_TOP, _TOP32 = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint32(0xFFFFFFFF)


# Anchors ------------------------------------------------------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best (np.minimum or np.maximum) of every ``width`` consecutive values, by running bests within blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.concatenate([values, np.full(blocks * width - n, values[-1], values.dtype)]).reshape(blocks, width)
    forward = best.accumulate(padded, axis=1).ravel()
    backward = best.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(backward[: n - width + 1], forward[width - 1 : n])


def anchors(shard: C.Shard, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes: all smallest grams of every window of ``length`` bytes inside one document."""
    width, places, hashes = length - GRAM + 1, [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    every = shard.offsets[1:] - 1
    for start in range(0, len(shard.buffer) - length + 1, BLOCK):
        text = shard.buffer[start : start + BLOCK + length - 1]
        grams, span = C._byte_codes()[text], 1
        while span < GRAM:
            grams = grams[:-span] * C.powers(64)[span] + grams[span:]
            span *= 2
        order = ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        ends = (every[np.searchsorted(every, start) : np.searchsorted(every, start + len(text))] - start).tolist()
        for end in ends:  # grams over the end of a document
            order[max(0, end - GRAM + 1) : end + 1] = _TOP32
        least = _sliding(order, width, np.minimum)
        for end in ends:  # windows over the end of a document
            least[max(0, end - length + 1) : end + 1] = 0
        none = np.zeros(width - 1, np.uint32)
        at = np.flatnonzero((_sliding(np.concatenate([none, least, none]), width, np.maximum) == order) & (order != _TOP32))
        places.append(start + at)
        hashes.append(C.mix(grams[at]))
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]


def _pieces(shard: C.Shard, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    doc = np.searchsorted(shard.offsets, at, side="right") - 1
    start = np.maximum(at - (length - GRAM), shard.offsets[doc])
    return start, np.minimum(at + length, shard.offsets[doc + 1] - 1)


def _contexts(length: int) -> list[tuple[int, int]]:
    """Bytes to the left and right of a gram; two pieces with a common window agree on at least one of them."""
    free = length - GRAM
    cuts = [round(j * (free + 1) / _CONTEXTS) for j in range(_CONTEXTS + 1)]
    return [(a, free - b + 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _digest(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "little")


def _entries(shard: C.Shard, at: np.ndarray, grams: np.ndarray, length: int) -> dict:
    """The distinct (gram, piece, place of the gram in the piece) of the given anchors, and which of them each anchor has.

    In a short periodic text several anchors have one and the same range as their piece, at different places in it:
    two anchors with equal pieces are two places only if the gram is at the same place in both.
    """
    start, end = _pieces(shard, at, length)
    raw = shard.buffer.tobytes()
    piece = np.array([_digest(raw[a:b], (i - a).to_bytes(4, "little")) for a, b, i in zip(start.tolist(), end.tolist(), at.tolist(), strict=True)], np.uint64)
    pairs = np.stack([grams, piece], 1)
    _, first, entry, count = np.unique(pairs, axis=0, return_index=True, return_inverse=True, return_counts=True)
    entry = entry.ravel()
    keys = np.zeros((len(first), _CONTEXTS), np.uint64)
    for e, i in enumerate(first.tolist()):
        a, low, high = int(at[i]), int(start[i]), int(end[i])
        for j, (left, right) in enumerate(_contexts(length)):
            if a - left >= low and a + GRAM + right <= high:
                keys[e, j] = _digest(raw[a - left : a + GRAM + right], bytes([j])) | 1
    return {
        "at": at, "entry": entry.astype(np.int64), "first": at[first], "gram": grams[first], "piece": piece[first],
        "twice": (count > 1).astype(np.uint8), "keys": keys.ravel(),
        "doc": np.searchsorted(shard.offsets, at[first], side="right") - 1,
    }


_ENTRY_TYPES = {"at": np.int64, "entry": np.int64, "first": np.int64, "gram": np.uint64, "piece": np.uint64, "twice": np.uint8, "keys": np.uint64, "doc": np.int64}


def _read_entries(row: dict) -> SimpleNamespace:
    return SimpleNamespace(**{name: np.frombuffer(row[name] or b"", kind) for name, kind in _ENTRY_TYPES.items()})


SAME, FIRST = 1, 2  # besides, bit 2 + j: context j is shared with another piece


def _answer(table: pa.Table) -> pa.Table:
    rows = table.to_pydict()
    grams = [np.frombuffer(x, np.uint64) for x in rows["gram"]]
    gram, piece = np.concatenate(grams), np.concatenate([np.frombuffer(x, np.uint64) for x in rows["piece"]])
    twice = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["twice"]])
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["keys"]]).reshape(-1, _CONTEXTS)
    order = np.lexsort((piece, gram))
    new = np.ones(len(order), bool)
    new[1:] = (gram[order[1:]] != gram[order[:-1]]) | (piece[order[1:]] != piece[order[:-1]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    said = np.zeros(len(order), np.uint8)
    said[(np.bincount(group)[group] > 1) | (np.bincount(group, twice)[group] > 0)] |= SAME
    firsts = order[new]
    said[firsts] |= FIRST
    for j in range(_CONTEXTS):
        own = firsts[keys[firsts, j] > 0]
        _, inverse, count = np.unique(keys[own, j], return_inverse=True, return_counts=True)
        said[own[count[inverse] > 1]] |= 1 << (2 + j)
    # The home of a gram: the first document with a piece that has to be compared.
    place = (np.repeat(np.array(rows["shard"]), [len(x) for x in grams]) << 20) | np.concatenate([np.frombuffer(x, np.int64) for x in rows["doc"]])
    place[(said & FIRST == 0) | (said < 4)] = np.iinfo(np.int64).max
    heads = np.flatnonzero(np.concatenate([[True], gram[order[1:]] != gram[order[:-1]]]))
    home = np.empty(len(order), np.int64)
    home[order] = np.repeat(np.minimum.reduceat(place[order], heads), np.diff(np.append(heads, len(order))))
    ends = np.cumsum([0, *map(len, grams)])

    def blobs(values):
        return pa.array([values[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())

    return pa.table({"part": table.column("part"), "shard": table.column("shard"), "said": blobs(said), "home": blobs(home)})


def _told(entries: SimpleNamespace, answers, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    said, home = np.zeros(len(entries.gram), np.uint8), np.zeros(len(entries.gram), np.int64)
    by_part = {a["part"]: a for a in answers or ()}
    for p, at, _ in C.blobs_by_part(C.part_of(entries.gram, n_parts), n_parts):
        said[at] = np.frombuffer(by_part[p]["said"], np.uint8)
        home[at] = np.frombuffer(by_part[p]["home"], np.int64)
    return said, home


# Suffix arrays ------------------------------------------------------------------------------------------------------


class Ranks:
    """Order of the strings of 8, 16, 32 and 64 bytes at each place; after the end of the text come zeros."""

    def __init__(self, text: np.ndarray, beyond: int):
        padded = np.concatenate([text, np.zeros(beyond + 64 + 7, np.uint8)]).astype(np.uint64)
        for span in (1, 2, 4):
            padded = (padded[:-span] << np.uint64(8 * span)) | padded[span:]
        self.eight, self.by_size = padded, {8: self._dense(padded)}
        for size in (8, 16, 32):
            rank = self.by_size[size].astype(np.int64)
            following = np.append(rank[size:], np.full(size, rank[-1]))
            self.by_size[2 * size] = self._dense(rank * len(rank) + following)

    @staticmethod
    def _dense(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        rank = np.empty(len(keys), np.int32)
        rank[order] = np.cumsum(new) - 1
        return rank

    def equal(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` bytes at each of ``a`` and ``b`` are the same."""
        same, open_, at = np.ones(len(a), bool), np.arange(len(a)), 0
        while at < length:
            size = next((s for s in (64, 32, 16, 8) if s <= length - at), 0)
            if size:
                rank = self.by_size[size]
                ok = rank[a[open_] + at] == rank[b[open_] + at]
            else:  # the last few bytes
                size = length - at
                ok = (self.eight[a[open_] + at] ^ self.eight[b[open_] + at]) >> np.uint64(8 * (8 - size)) == 0
            same[open_[~ok]] = False
            open_, at = open_[ok], at + size
        return same


def _sort_directly(places: np.ndarray, ranks: Ranks, depth: int) -> np.ndarray:
    """``places`` in the order of the suffixes there, by ``depth`` bytes; equal ones stay in order of place."""
    rank = ranks.by_size[64]
    order = places[np.argsort(rank[places], kind="stable")]
    if len(order) < 2:
        return order
    new = np.ones(len(order), bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    for step in range(64, depth, 64):
        head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            break
        key = head[tied] * len(rank) + rank[order[tied] + step]
        by = np.argsort(key, kind="stable")
        order[tied], key = order[tied[by]], key[by]
        new[tied[1:]] |= key[1:] != key[:-1]
    return order


def two_stage_suffix_array(text: np.ndarray, depth: int, ranks: Ranks | None = None) -> np.ndarray:
    """The suffixes of ``text`` in order, by at least ``depth`` bytes.

    Directly sorted are only suffixes that are smaller than their successors. Any other suffix is larger than the one
    after it, so a scan over the buckets of first bytes from the smallest on meets the successor first and appends it.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    ranks = Ranks(text, depth) if ranks is None else ranks
    change = np.flatnonzero(text[1:] != text[:-1])
    following = np.searchsorted(change, np.arange(n))
    rises = np.append(text[change] < text[change + 1], False)  # after the last change a suffix outlasts its successor
    smaller = rises[following]
    direct = _sort_directly(np.flatnonzero(smaller), ranks, depth)
    edges = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[n - 1]].append(np.array([n - 1]))
    result = []
    for byte in range(256):
        level = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        bucket = []
        while len(level):  # a run of this byte: each level holds the predecessors of the one before
            bucket.append(level)
            before = level[level > 0] - 1
            level = before[(text[before] == byte) & ~smaller[before]]
        bucket.append(direct[edges[byte] : edges[byte + 1]])
        whole = np.concatenate(bucket)
        result.append(whole)
        before = whole[whole > 0] - 1
        before = before[text[before] > byte]
        if len(before):
            before = before[np.argsort(text[before], kind="stable")]
            cuts = np.flatnonzero(np.diff(text[before])) + 1
            for part in np.split(before, cuts):
                induced[text[part[0]]].append(part)
    return np.concatenate(result)


def _repeats(segments: list[bytes], shards: np.ndarray, starts: np.ndarray, known: list[np.ndarray], length: int):
    """Segment and offset of each window that repeats in another place and is not among the ``known`` spans."""
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    sizes = np.array([len(p) for p in segments])
    heads = np.cumsum(sizes + 1) - sizes - 1
    ranks = Ranks(text, length + 64)
    order = two_stage_suffix_array(text, length, ranks)
    spans = np.concatenate([k + h for k, h in zip(known, heads, strict=True)])  # spans of repeats, not of windows
    sure = C.covered(len(text), spans[:, 0], np.maximum(spans[:, 1] - length + 1, spans[:, 0]))
    segment = np.searchsorted(heads, order, side="right") - 1
    fits = order - heads[segment] + length <= sizes[segment]
    order, segment = order[fits], segment[fits]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Adjacent suffixes with a common prefix of the full length are one run.
    run = np.cumsum(np.concatenate([[True], ~ranks.equal(order[1:], order[:-1], length)])) - 1
    offset = order - heads[segment]
    place, shard = starts[segment] + offset, shards[segment]
    head = np.searchsorted(run, run)  # first of the run
    differs = (shard != shard[head]) | (place != place[head]) | sure[order]
    repeats = (np.bincount(run, differs)[run] > 0) & ~sure[order]
    return segment[repeats], offset[repeats]


# The operator -------------------------------------------------------------------------------------------------------


def _pairs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, 2)


def _sort_groups(length: int):
    def make(rows) -> Iterator[dict]:
        shards, starts = np.array(rows["shard"]), np.array(rows["start"])
        segment, offset = _repeats(rows["segment"], shards, starts, [_pairs(x) for x in rows["known"]], length)
        if len(segment):
            order = np.lexsort((offset, segment))
            segment, offset = segment[order], offset[order]
            new = np.ones(len(segment), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
            head, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:] - 1, len(segment) - 1)
            at = starts[segment[head]] + offset[head]
            yield {"shard": shards[segment[head]], "start": at, "end": at + offset[last] - offset[head] + length}

    return make


_WINDOWS = "w1 long, w2 long, shard long, start long, sure boolean"


def _window_hashes(length: int):
    """Two hashes of each window of the segments; for homes with too much text to be sorted together."""
    fields = C.pa_schema(_WINDOWS)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, n = C._byte_codes()[np.frombuffer(row["segment"], np.uint8)], len(row["segment"])
                weight, inverse = C.powers(n + 1), C.inverse_powers(n + 1)
                hashes = []
                for values in (codes, C.mix(codes)):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(values * weight[:n])])
                    hashes.append(C.mix((total[length:] - total[:-length]) * inverse[: n - length + 1]))
                at, known = np.arange(n - length + 1), _pairs(row["known"])
                sure = C.covered(n, known[:, 0], np.maximum(known[:, 1] - length + 1, known[:, 0]))[: len(at)]
                yield C.record_batch({"w1": hashes[0].view(np.int64), "w2": hashes[1].view(np.int64), "shard": np.full(len(at), row["shard"]), "start": row["start"] + at, "sure": sure}, fields)

    return run


def without_repeats(docs: DataFrame, length: int = 400, texts: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept`` if ``texts``) for every row of ``docs``.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else, in the same or another
    document; strings never cross documents and are judged on the input. A null text is empty. Rows with equal or null
    ids are separate documents. ``n_spans`` counts maximal removed runs; ``kept`` are the remaining bytes, which need
    not be whole characters.
    """
    shards = C.shards_of(docs)
    parts = C.parts_for(shards)
    flags = C.shared_flags(shards, lambda shard: C.distinct_with_twice(anchors(shard, length)[1]), parts)

    def describe(shard, answers):
        at, grams = anchors(shard, length)
        keys = np.unique(grams)
        shared = C.in_sorted(grams, keys[C.read_flags(keys, parts, answers)])
        if shared.any():
            found = _entries(shard, at[shared], grams[shared], length)
            yield {"shard": [shard.shard]} | {name: [found[name].tobytes()] for name in _ENTRY_TYPES}

    entry_schema = "shard long, " + ", ".join(f"{name} binary" for name in _ENTRY_TYPES)
    entries = C.staged(C.map_shards(shards.join(flags, "shard"), describe, entry_schema, "answers"))

    ask_schema = "part long, shard long, gram binary, piece binary, twice binary, keys binary, doc binary"
    ask_fields = C.pa_schema(ask_schema)

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                e = _read_entries(row)
                keys = e.keys.reshape(-1, _CONTEXTS)
                for p, at, _ in C.blobs_by_part(C.part_of(e.gram, parts), parts):
                    yield C.record_batch({"part": [p], "shard": [row["shard"]], "gram": [e.gram[at].tobytes()], "piece": [e.piece[at].tobytes()], "twice": [e.twice[at].tobytes()], "keys": [keys[at].tobytes()], "doc": [e.doc[at].tobytes()]}, ask_fields)

    asked = entries.select("shard", *_ENTRY_TYPES).mapInArrow(ask, ask_schema)
    answers = asked.groupBy("part").applyInArrow(_answer, "part long, shard long, said binary, home binary")
    told = C.staged(entries.join(answers.groupBy("shard").agg(F.collect_list(F.struct("part", "said", "home")).alias("answers")), "shard"))
    facts = told.select("shard", F.struct(*_ENTRY_TYPES, "answers").alias("facts"))

    def cut(shard, facts):
        e = _read_entries(facts)
        said, home = _told(e, facts["answers"], parts)
        chosen = np.flatnonzero((said & FIRST > 0) & (said >= 4))
        if not len(chosen):
            return
        start, end = _pieces(shard, e.first[chosen], length)
        raw, out = shard.buffer.tobytes(), []
        order = np.argsort(home[chosen], kind="stable")
        homes, heads = np.unique(home[chosen][order], return_index=True)
        for where, own in zip(homes.tolist(), np.split(order, heads[1:]), strict=True):
            same = own[said[chosen[own]] & SAME > 0]
            same = same[np.argsort(start[same], kind="stable")]
            for a, b in zip(*(x.tolist() for x in C.merge_spans(start[own], end[own])), strict=True):
                inside = same[np.searchsorted(start[same], a) : np.searchsorted(start[same], b)]
                known = np.stack([start[inside] - a, end[inside] - a], 1).astype(np.int64)
                out.append((where, shard.shard, a, raw[a:b], known.tobytes()))
        yield dict(zip(("home", "shard", "start", "segment", "known"), zip(*out, strict=True), strict=True))

    segments = C.staged(C.map_shards(shards.join(facts, "shard"), cut, "home long, shard long, start long, segment binary, known binary", "facts"))
    crowded = segments.groupBy("home").agg(F.sum(F.length("segment")).alias("n")).filter(F.col("n") > SORT_LIMIT).select("home")
    total = segments.agg(F.sum(F.length("segment"))).first()[0] or 0
    sorted_in = segments.join(crowded, "home", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("home"), F.lit(max(1, total // SORT_BYTES))))
    spans = C.map_groups(sorted_in, ["bucket"], _sort_groups(length), "shard long, start long, end long")
    counted = segments.join(crowded, "home", "left_semi").mapInArrow(_window_hashes(length), _WINDOWS)
    place = F.struct("shard", "start")
    twice = counted.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("sure").alias("s")).filter("s or a <> b")
    more = counted.filter("not sure").join(twice.select("w1", "w2"), ["w1", "w2"]).select("shard", "start", (F.col("start") + length).alias("end"))
    spans = spans.unionByName(more).distinct().groupBy("shard").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def finish(shard, facts, spans):
        e = _read_entries(facts or dict.fromkeys(_ENTRY_TYPES))
        said, _ = _told(e, facts and facts["answers"], parts)
        start, end = _pieces(shard, e.at[said[e.entry] & SAME > 0], length)
        extra = np.array([(s["start"], s["end"]) for s in spans or ()], np.int64).reshape(-1, 2)
        start, end = C.merge_spans(np.append(start, extra[:, 0]), np.append(end, extra[:, 1]))
        gone = C.covered(len(shard.buffer), start, end)
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[shard.offsets[1:]] - total[shard.offsets[:-1]]
        doc = np.searchsorted(shard.offsets, start, side="right") - 1
        kept = shard.buffer[~gone].tobytes()
        at = shard.offsets - total[shard.offsets]
        kept = [kept[a : b - 1] for a, b in zip(at[:-1], at[1:], strict=True)]
        out = {"doc_id": C.id_array(shard), "n_bytes": np.diff(shard.offsets) - 1, "n_removed": removed, "n_spans": np.bincount(doc, minlength=shard.n), "kept_sha256": [C.sha256(x) for x in kept]}
        yield out | ({"kept": kept} if texts else {})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    joined = shards.join(facts, "shard", "left").join(C.staged(spans), "shard", "left")
    return C.map_shards(joined, finish, schema, "facts", "spans")

"""Removal of repeated word windows, counted exactly in super-k-mers.

Each window of k words has a minimiser, the smallest hash among its runs of m words. Consecutive windows with the same
minimiser overlap in all but one word, so they travel together as one packed string of words, a super-k-mer, to the
part that owns the minimiser. Equal windows have equal minimisers, so a part sees all copies of its windows; sorting
brings them together, and all but the first are repeats.

Only minimisers that occur more than once anywhere can have repeated windows, so only their super-k-mers travel, and of
equal super-k-mers in a shard only the first; the others are known to be repeats.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C


def _scan(shard: C.Shard, k: int, m: int) -> SimpleNamespace:
    """The words of a shard, and its super-k-mers: windows ``first .. first + windows - 1`` with minimiser ``key``."""
    starts, ends = C.words_of(shard.buffer)
    hashes, firsts = C.run_hashes(shard.buffer, starts, ends), C.firsts_of(starts, shard.offsets)
    grams = C.shingle_hashes(hashes, m)
    least = C.window_minima(grams, k - m + 1)
    window = np.flatnonzero(C.valid_starts(firsts, k, len(least)))
    at = least[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    head = np.flatnonzero(new)
    doc = np.repeat(np.arange(shard.n), np.diff(firsts))
    # Order of documents: by id, then by row.
    place = np.empty(shard.n, np.int64)
    place[np.argsort(shard.ids, kind="stable")] = np.arange(shard.n)
    first = window[head]
    return SimpleNamespace(
        starts=starts, ends=ends, hashes=hashes, firsts=firsts, doc=doc, place=place,
        first=first, windows=np.diff(np.append(head, len(window))), key=grams[at[head]],
    )


def _asked(scan: SimpleNamespace, shared: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Super-k-mers to send, by number, and those that equal an earlier one of the shard."""
    chosen = np.flatnonzero(C.in_sorted(scan.key, shared))
    if not len(chosen):
        return chosen, chosen
    length = scan.windows[chosen] + k - 1
    spread = np.repeat(scan.first[chosen] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
    within = spread - np.repeat(scan.first[chosen], length)
    heads = np.concatenate([[0], np.cumsum(length)[:-1]])
    words = scan.hashes[spread]
    one = np.add.reduceat(words * C.powers(int(length.max()))[within], heads) + length.astype(np.uint64)
    two = np.add.reduceat(C.mix(words) * C.powers(int(length.max()))[within], heads)
    order = np.lexsort((scan.first[chosen], scan.place[scan.doc[scan.first[chosen]]], two, one))
    again = np.zeros(len(chosen), bool)
    again[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
    return chosen[~again], chosen[again]


def _by_part(scan: SimpleNamespace, sent: np.ndarray, n_parts: int):
    return C.blobs_by_part(C.part_of(scan.key[sent], n_parts), n_parts)


def _codes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of each word hash, as they travel."""
    return hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint16)


def _answer(k: int):
    """One bit per window of a part: whether it also starts earlier."""

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        lengths = [np.frombuffer(x, np.int32) for x in rows["lengths"]]
        length = np.concatenate(lengths).astype(np.int64)
        words = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["low"]]).astype(np.uint64)
        words |= np.concatenate([np.frombuffer(x, np.uint16) for x in rows["high"]]).astype(np.uint64) << np.uint64(32)
        column = {name: np.concatenate([np.frombuffer(x, np.int64) for x in rows[name]]) for name in ("ids", "docs", "starts")}
        column["shard"] = np.repeat(np.array(rows["shard"]), [len(x) for x in lengths])
        count = length - k + 1
        heads = np.concatenate([[0], np.cumsum(length)[:-1]])
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(heads, count) + within
        window = C.shingle_hashes(words, k)[at]
        order = np.argsort(window, kind="stable")
        equal = window[order[1:]] == window[order[:-1]]
        near = np.flatnonzero(equal)
        for j in range(k):  # word by word, so that no collision of hashes counts
            equal[near] &= words[at[order[near + 1]] + j] == words[at[order[near]] + j]
        group = np.concatenate([[0], np.cumsum(~equal)])
        many = np.repeat(np.bincount(group) > 1, np.bincount(group))
        order, group = order[many], group[many]
        run = np.repeat(np.arange(len(length)), count)
        again = np.zeros(len(at), bool)
        if len(order):
            r = run[order]
            by = np.lexsort((column["starts"][r] + within[order], column["docs"][r], column["shard"][r], column["ids"][r], group))
            g = group[by]
            later = np.concatenate([[False], g[1:] == g[:-1]])
            again[order[by[later]]] = True
        sizes = [int(x.sum()) - (k - 1) * len(x) for x in lengths]
        ends = np.cumsum([0, *sizes])
        bits = [np.packbits(again[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({"part": table.column("part"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})

    return answer


def _judged(docs: DataFrame, k: int, m: int, carry: bool):
    """The shards with what is known of their windows, and a function that tells the words to remove from it."""
    shards, buckets = C.bucketed_shards(docs, carry=carry)
    parts = C.parts_for(shards)
    flags = C.staged(C.shared_flags(shards, lambda shard: C.distinct_with_twice(_scan(shard, k, m).key), parts, buckets=buckets))

    def read(shard, answers):
        scan = _scan(shard, k, m)
        keys = np.unique(scan.key)
        return scan, *_asked(scan, keys[C.read_flags(keys, parts, answers)], k)

    def send(shard, answers):
        scan, sent, _ = read(shard, answers)
        rows = []
        for p, at, _ in _by_part(scan, sent, parts):
            chosen = sent[at]
            length = scan.windows[chosen] + k - 1
            spread = np.repeat(scan.first[chosen] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            doc = scan.doc[scan.first[chosen]]
            rows.append((p, length.astype(np.int32), *_codes(scan.hashes[spread]), shard.ids[doc], doc, scan.first[chosen] - scan.firsts[doc]))
        if rows:
            names = ("part", "lengths", "low", "high", "ids", "docs", "starts")
            columns = dict(zip(names, zip(*rows, strict=True), strict=True))
            yield {"part": columns.pop("part"), "shard": [shard.shard] * len(rows)} | {name: [a.tobytes() for a in arrays] for name, arrays in columns.items()}

    flagged = shards.join(flags, "shard", "left")
    schema = "part long, shard long, lengths binary, low binary, high binary, ids binary, docs binary, starts binary"
    sent = C.map_shards(flagged, send, schema, "answers")
    answers = sent.groupBy("part").applyInArrow(_answer(k), "part long, shard long, bits binary")
    repeats = C.staged(C.to_buckets(answers, buckets, F.collect_list(F.struct("part", "bits")).alias("repeats")))

    def repeated(shard, answers, repeats) -> tuple[SimpleNamespace, np.ndarray]:
        scan, sent, known = read(shard, answers)
        by_part = {a["part"]: a["bits"] for a in repeats or ()}
        first, last = [scan.first[known]], [scan.first[known] + scan.windows[known] - 1]
        for p, at, _ in _by_part(scan, sent, parts):
            chosen = sent[at]
            windows = scan.windows[chosen]
            bits = np.unpackbits(np.frombuffer(by_part[p], np.uint8), count=int(windows.sum())).astype(bool)
            at = np.repeat(scan.first[chosen] - (np.cumsum(windows) - windows), windows) + np.arange(len(bits))
            first.append(at[bits])
            last.append(at[bits])
        return scan, C.covered(len(scan.starts), np.concatenate(first), np.concatenate(last) + k)

    return flagged.join(repeats, "shard", "left"), repeated


def without_repeats(docs: DataFrame, k: int = 20, m: int = 5) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs`` (``doc_id, text``, more columns are ignored).

    Removed is each word covered by a window of ``k`` consecutive words of one document whose words also start
    earlier: in a document of a smaller id, or earlier in the same one. Windows are judged on the input. Words are runs
    without white space, unchanged; null and empty texts have none. Rows with equal ids are separate documents in a
    fixed order; a null id counts as the smallest. ``kept_sha256`` is of the kept words joined by one space. Words are
    compared as hashes of 48 bits, in all ``k`` places of a window.
    """
    shards, repeated = _judged(docs, k, m, carry=False)

    def finish(shard, answers, repeats):
        scan, gone = repeated(shard, answers, repeats)
        total = np.concatenate([[0], np.cumsum(gone)])
        joined, ends = _kept_bytes(shard.buffer, scan, gone)
        raw = joined.tobytes()
        yield {
            "doc_id": C.id_array(shard), "n_words": np.diff(scan.firsts), "n_removed": total[scan.firsts[1:]] - total[scan.firsts[:-1]],
            "kept_sha256": [C.sha256(raw[a : max(a, b - 1)]) for a, b in zip(ends[:-1], ends[1:], strict=True)],
        }

    return C.map_shards(shards, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", "answers", "repeats")


def remove_repeats(docs: DataFrame, k: int = 20, m: int = 5) -> DataFrame:
    """``docs`` with the words cut out that :func:`without_repeats` removes, and the white space after them.

    All rows and columns stay; ``n_chars``, if there, counts the new text. A null text stays null.
    """
    shards, repeated = _judged(docs, k, m, carry=True)
    return C.whole_rows(shards, docs.schema, lambda shard, *facts: _kept_texts(shard, *repeated(shard, *facts)), "answers", "repeats")


def _kept_bytes(buffer: np.ndarray, scan: SimpleNamespace, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words, each followed by one space, and where each document begins in them."""
    starts, length = scan.starts[~gone], scan.ends[~gone] - scan.starts[~gone] + 1
    heads = np.concatenate([[0], np.cumsum(length)])
    out = buffer[np.repeat(starts - heads[:-1], length) + np.arange(heads[-1])]
    out[heads[1:] - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(~gone)])
    return out, heads[kept[scan.firsts]]


def _kept_texts(shard: C.Shard, scan: SimpleNamespace, gone: np.ndarray) -> list[str]:
    """The texts without the removed words and the white space after them."""
    following = np.append(scan.starts[1:], len(shard.buffer))
    ends = np.minimum(following, shard.offsets[1:][scan.doc] - 1)
    return C.cut_texts(shard, scan.starts[gone], ends[gone])

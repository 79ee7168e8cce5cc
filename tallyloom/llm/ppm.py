"""Language-model scores by prediction by partial matching (PPM) over bytes, next to a word-count baseline.

The model is a trie of byte contexts up to four bytes long, with the count of each following byte over all training
texts. A byte is coded in the longest context of the trie; if it was never seen there, an escape is coded, in
proportion to the number of distinct bytes seen (method C), and the next shorter context is tried without the bytes
that the longer one has already ruled out. The model is trained in advance and stays fixed while it scores.

Contexts nest, so what a context rules out in the next shorter one is a fixed sum per context. All code lengths are
therefore numbers per node, and scoring is a lookup per byte.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

ORDER = 4
#: Bound of the trie that :func:`train` gathers; the scores of texts don't use it and count every node.
MAX_NODES = 4_000_000
#: Bytes of text whose nodes one part owns.
_PART_BYTES = 16 << 20
_HELD = 2_000_000


def fold(doc_id: int | None, folds: int) -> int | None:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def held_out(shard: C.Shard, folds: int, chosen: int) -> np.ndarray:
    return np.array([known and fold(i, folds) == chosen for i, known in zip(shard.ids.tolist(), shard.known.tolist(), strict=True)], bool)


# The trie -----------------------------------------------------------------------------------------------------------


def nodes_of(buffer: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Per byte, its ``order`` predecessors and itself as one number. What lies before the start of a text counts as ``END``."""
    padded = np.concatenate([np.full(order, C.END, np.uint8), buffer])
    key, closed = buffer.astype(np.uint64), np.zeros(len(buffer), bool)
    for back in range(1, order + 1):
        before = padded[order - back : order - back + len(buffer)]
        closed |= before == C.END
        key |= np.where(closed, np.uint8(C.END), before).astype(np.uint64) << np.uint64(8 * back)
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, inverse = np.unique(keys, return_inverse=True)
    total = np.zeros(len(values), np.int64)
    np.add.at(total, inverse, counts)
    return values, total


class Trie:
    """Log10 probabilities of a set of counted nodes, ready for lookups; ``keys`` are ascending.

    With ``low``, the nodes of order 1 over all texts, ``keys`` may be only those of some contexts of two bytes; then
    what follows these contexts is scored as if all nodes were given.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int = ORDER, low: tuple[np.ndarray, np.ndarray] | None = None):
        self.order, deepest, self.levels = order, order, []  # from the longest context to the empty one
        key, count = keys.astype(np.uint64), counts.astype(np.int64)
        longer = None
        for order in range(deepest, -1, -1):
            if order < deepest and order == 1 and low is not None:
                key, count = low
            elif order < deepest:
                key, count = _summed(key & np.uint64((1 << 8 * (order + 1)) - 1), count)
            context, at, distinct = np.unique(key >> np.uint64(8), return_inverse=True, return_counts=True)
            total = np.bincount(at, count, len(context))
            whole = np.log10(np.maximum(total + distinct, 1))
            level = {"key": key, "count": np.log10(count), "plain": np.log10(count) - whole[at], "context": context, "escape": np.log10(np.maximum(distinct, 1)) - whole}
            if longer is not None:
                # What each longer context leaves of this one.
                own = longer["raw_key"] & np.uint64((1 << 8 * (order + 1)) - 1)
                ruled_out = np.bincount(longer["at"], count[np.searchsorted(key, own)], len(longer["context"]))
                parent = np.searchsorted(context, longer["context"] & np.uint64((1 << 8 * order) - 1))
                left, kinds = total[parent] - ruled_out, distinct[parent] - longer["distinct"]
                longer["rest"] = np.log10(np.maximum(left + kinds, 1))
                longer["rest_escape"] = np.where(kinds > 0, np.log10(np.maximum(kinds, 1)) - longer["rest"], 0.0)
            longer = level | {"raw_key": key, "at": at, "distinct": distinct}
            level = longer
            self.levels.append(level)
        last = self.levels[-1]
        seen = int(last["distinct"][0]) if len(last["distinct"]) else 0
        self.uniform = -np.log10(max(1, 256 - seen))
        for level in self.levels:
            for name in ("raw_key", "at", "distinct"):
                level.pop(name)

    def score(self, node: np.ndarray) -> np.ndarray:
        """The log10 probability of each byte, given its predecessors."""
        if not len(self.levels[0]["key"]):
            return np.full(len(node), self.uniform)
        # Nearly all bytes end in the longest context.
        longer = self.levels[0]
        at = np.minimum(np.searchsorted(longer["key"], node), len(longer["key"]) - 1)
        result = longer["plain"][at]
        open_ = np.flatnonzero(longer["key"][at] != node)
        result[open_] = 0
        ruled = np.full(len(open_), -1)  # number of the longer context that an escape came from
        for order in range(self.order, -1, -1):
            level = self.levels[self.order - order]
            key = node[open_] & np.uint64((1 << 8 * (order + 1)) - 1)
            if order < self.order:
                at = np.minimum(np.searchsorted(level["key"], key), len(level["key"]) - 1)
                found = level["key"][at] == key
                at, from_ = at[found], ruled[found]
                result[open_[found]] += np.where(from_ >= 0, level["count"][at] - longer["rest"][from_], level["plain"][at])
                open_, key, ruled = open_[~found], key[~found], ruled[~found]
            if not len(open_):
                return result
            context = np.minimum(np.searchsorted(level["context"], key >> np.uint64(8)), len(level["context"]) - 1)
            there = level["context"][context] == key >> np.uint64(8)
            escape = level["escape"][context]
            if order < self.order:
                escape = np.where(ruled >= 0, longer["rest_escape"][ruled], escape)
            result[open_] += np.where(there, escape, 0.0)
            ruled, longer = np.where(there, context, -1), level
        result[open_] += self.uniform
        return result


def train(shards: DataFrame, folds: int, chosen: int, n_parts: int) -> Trie:
    """A bounded trie of the texts that are not held out, gathered on the driver."""
    fields = C.pa_schema("part long, keys binary, counts binary")

    def rows(keys, counts):
        part = C.part_of(C.mix(keys), n_parts)
        made = [(p, *blobs) for p, _, blobs in C.blobs_by_part(part, n_parts, keys, counts)]
        return C.record_batch(dict(zip(fields.names, zip(*made, strict=True), strict=True)), fields)

    def count(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = C.unpack(number, payload)
                used = np.repeat(~held_out(shard, folds, chosen), np.diff(shard.offsets))
                own, n = np.unique(nodes_of(shard.buffer)[used], return_counts=True)
                keys, counts = _summed(np.concatenate([keys, own]), np.concatenate([counts, n]))
                if len(keys) > _HELD:
                    yield rows(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield rows(keys, counts)

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()])
        keys, counts = _summed(keys, counts)
        return pa.table({"n": pa.array([len(keys)], pa.int64()), "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary())})

    summed = shards.select("shard", "payload").mapInArrow(count, "part long, keys binary, counts binary").groupBy("part").applyInArrow(add, "n long, keys binary, counts binary")
    summed = C.staged(summed)
    nodes = summed.agg(F.sum("n")).first()[0] or 0
    if nodes > MAX_NODES:
        summed = _most_frequent(summed)
    parts = summed.select("keys", "counts").collect()  # at most MAX_NODES nodes of 12 bytes
    keys = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["keys"], np.uint64) for r in parts)])
    counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in parts)])
    order = np.argsort(keys)
    return Trie(keys[order], counts[order])


def _most_frequent(summed: DataFrame) -> DataFrame:
    """Only nodes above the smallest count that leaves at most ``MAX_NODES``."""
    fields, histogram = C.pa_schema("n long, keys binary, counts binary"), C.pa_schema("count long, nodes long")

    def by_count(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                values, n = np.unique(np.minimum(np.frombuffer(blob, np.int64), 1 << 20), return_counts=True)
                yield C.record_batch({"count": values, "nodes": n}, histogram)

    sizes = summed.select("counts").mapInArrow(by_count, "count long, nodes long").groupBy("count").agg(F.sum("nodes").alias("nodes"))
    total, least = 0, (1 << 20) + 1
    for row in sizes.orderBy(F.desc("count")).toLocalIterator():
        total += row["nodes"]
        if total > MAX_NODES:
            break
        least = row["count"]

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
                kept = counts >= least
                yield C.record_batch({"n": [int(kept.sum())], "keys": [keys[kept].tobytes()], "counts": [counts[kept].tobytes()]}, fields)

    return summed.select("n", "keys", "counts").mapInArrow(cut, "n long, keys binary, counts binary")


# Scores of nodes ----------------------------------------------------------------------------------------------------


def _planes(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number, first bytes first: ascending or small numbers compress well so."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(blobs: list[bytes], width: int) -> list[np.ndarray]:
    found = []
    for blob in blobs:
        values = np.zeros((len(blob) // width, 8), np.uint8)
        values[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
        found.append(values.reshape(-1).view("<u8"))
    return found


_NODE, _COUNT = ORDER + 1, 5


def _binary(blobs: list[bytes]) -> pa.Array:
    return pa.array(blobs, pa.binary())


def _nodes_and_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    nodes = np.concatenate(_from_planes(table.column("nodes").to_pylist(), _NODE))
    return nodes, np.concatenate(_from_planes(table.column("counts").to_pylist(), _COUNT)).astype(np.int64)


def node_scores(shards: DataFrame, folds: int, chosen: int, n_parts: int) -> DataFrame:
    """``part, shard, scores``: the log10 probability of every distinct node of a shard, by the model of all training texts.

    The part of a node's hash adds up its count. Then nodes meet that have the same last two bytes of context, which
    are at most 2^24: they have all that contexts of two to four bytes need, and the nodes of order 1, at most 2^16,
    are sent to all. The scores go back to the part of the hash, which answers the shards.
    """

    def ask(shard):
        nodes, held = nodes_of(shard.buffer), np.repeat(held_out(shard, folds, chosen), np.diff(shard.offsets))
        own, n = np.unique(nodes[~held], return_counts=True)
        every = np.union1d(own, nodes[held])
        counts = np.zeros(len(every), np.int64)
        counts[np.searchsorted(every, own)] = n
        rows = [(p, _planes(every[at], _NODE), _planes(counts[at], _COUNT)) for p, at, _ in C.blobs_by_part(C.part_of(C.mix(every), n_parts), n_parts)]
        if rows:
            part, nodes, counts = zip(*rows, strict=True)
            yield {"part": part, "shard": [shard.shard] * len(rows), "nodes": nodes, "counts": counts}

    def add(table: pa.Table) -> pa.Table:
        nodes, counts = _summed(*_nodes_and_counts(table))
        group = C.part_of(C.mix(nodes >> np.uint64(8) & np.uint64(0xFFFF)), n_parts)
        rows = [(p, _planes(nodes[at], _NODE), _planes(counts[at], _COUNT)) for p, at, _ in C.blobs_by_part(group, n_parts)]
        return pa.table({"group": pa.array([r[0] for r in rows], pa.int64()), "nodes": _binary([r[1] for r in rows]), "counts": _binary([r[2] for r in rows])})

    def first_order(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                nodes, counts = _nodes_and_counts(pa.Table.from_batches([batch.slice(i, 1)]))
                total += np.bincount((nodes & np.uint64(0xFFFF)).astype(np.int64), counts, 1 << 16).astype(np.int64)
        there = np.flatnonzero(total)
        yield C.record_batch({"node": there, "n": total[there]}, C.pa_schema("node long, n long"))

    asked = C.staged(C.map_shards(shards, ask, "part long, shard long, nodes binary, counts binary"))
    summed = C.staged(asked.select("part", "nodes", "counts").groupBy("part").applyInArrow(add, "group long, nodes binary, counts binary"))
    rows = summed.select("nodes", "counts").mapInArrow(first_order, "node long, n long").groupBy("node").agg(F.sum("n")).collect()  # at most 2^16
    rows.sort()
    low = np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.int64)
    sent = shards.sparkSession.sparkContext.broadcast(low)

    def score(table: pa.Table) -> pa.Table:
        nodes, counts = _nodes_and_counts(table)
        order = np.argsort(nodes)
        nodes, counts = nodes[order], counts[order]
        seen = counts > 0
        if seen.any():
            found = Trie(nodes[seen], counts[seen], low=sent.value).score(nodes)
        else:
            found = Trie(*sent.value, 1).score(nodes & np.uint64(0xFFFF))
        rows = [(p, _planes(nodes[at], _NODE), own) for p, at, (own,) in C.blobs_by_part(C.part_of(C.mix(nodes), n_parts), n_parts, found)]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int64()), "nodes": _binary([r[1] for r in rows]), "scores": _binary([r[2] for r in rows])})

    def answer(table: pa.Table) -> pa.Table:
        known, asks = table.filter(pc.is_valid(table.column("scores"))), table.filter(pc.is_null(table.column("scores")))
        nodes = np.concatenate(_from_planes(known.column("nodes").to_pylist(), _NODE))
        scores = np.concatenate([np.frombuffer(x, np.float64) for x in known.column("scores").to_pylist()])
        order = np.argsort(nodes)
        nodes, scores = nodes[order], scores[order]
        said = [scores[np.searchsorted(nodes, own)].tobytes() for own in _from_planes(asks.column("nodes").to_pylist(), _NODE)]
        return pa.table({"part": asks.column("part"), "shard": asks.column("shard"), "scores": _binary(said)})

    scored = summed.groupBy("group").applyInArrow(score, "part long, nodes binary, scores binary")
    both = asked.select("part", "shard", "nodes", F.lit(None).cast("binary").alias("scores")).unionByName(
        scored.select("part", F.lit(None).cast("long").alias("shard"), "nodes", "scores")
    )
    return both.groupBy("part").applyInArrow(answer, "part long, shard long, scores binary")


# Words --------------------------------------------------------------------------------------------------------------


def _shard_words(shard: C.Shard):
    buffer = C.lower_table()[shard.buffer]
    starts, ends = C.words_of(buffer)
    words, number = np.unique(C.run_hashes(buffer, starts, ends), return_inverse=True)
    return words, number, C.firsts_of(starts, shard.offsets)


def word_counts(shards: DataFrame, folds: int, chosen: int, n_parts: int) -> DataFrame:
    """``part, shard, counts, distinct, total``: the training count of every word of a shard, and totals once per part."""

    def ask(shard):
        words, number, firsts = _shard_words(shard)
        used = np.repeat(~held_out(shard, folds, chosen), np.diff(firsts))
        own = np.bincount(number[used], minlength=len(words)).astype(np.int64)
        rows = [(p, *blobs) for p, _, blobs in C.blobs_by_part(C.part_of(words, n_parts), n_parts, words, own)]
        if rows:
            part, hashes, counts = zip(*rows, strict=True)
            yield {"part": part, "shard": [shard.shard] * len(rows), "words": hashes, "counts": counts}

    def answer(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()])
        values, inverse = np.unique(np.concatenate(blobs), return_inverse=True)
        total = np.bincount(inverse, counts, len(values)).astype(np.int64)
        ends, rest = np.cumsum([0, *map(len, blobs)]), [0] * (len(blobs) - 1)
        said = total[inverse]
        return pa.table({
            "part": table.column("part"), "shard": table.column("shard"),
            "counts": pa.array([said[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
            "distinct": pa.array([int((total > 0).sum()), *rest], pa.int64()), "total": pa.array([int(total.sum()), *rest], pa.int64()),
        })

    asked = C.map_shards(shards, ask, "part long, shard long, words binary, counts binary")
    return asked.groupBy("part").applyInArrow(answer, "part long, shard long, counts binary, distinct long, total long")


# The operator -------------------------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, folds: int = 5, chosen: int = 1) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Learns from all rows whose crc32 of the id, as text, modulo ``folds`` is not ``chosen``; rows with a null id are
    learned from. ``score`` is the log10 probability that the PPM model gives to the bytes of the text and its end.
    Tokens are words (runs without white space, A-Z lower-cased) and one end per text; ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over them. Null and empty texts consist of their end alone. Words are counted
    by 64-bit hashes. Without any training text all counts are 0.
    """
    shards = C.shards_of(docs)
    parts = C.parts_for(shards)
    node_parts = C.parts_for(shards, _PART_BYTES)
    likely = C.staged(node_scores(shards, folds, chosen, node_parts))
    answers = C.staged(word_counts(shards, folds, chosen, parts))
    totals = answers.agg(F.sum("distinct"), F.sum("total")).first()

    def count_texts(shard):
        yield {"n": [int((~held_out(shard, folds, chosen)).sum())]}

    ends = C.map_shards(shards, count_texts, "n long").agg(F.sum("n")).first()[0] or 0
    distinct, total = (totals[0] or 0) + (ends > 0), (totals[1] or 0) + ends

    def score(shard, answers):
        words, number, firsts = _shard_words(shard)
        counts, by_part = np.zeros(len(words), np.int64), {a["part"]: a["blob"] for a in answers or () if a["word"]}
        for p, at, _ in C.blobs_by_part(C.part_of(words, parts), parts):
            counts[at] = np.frombuffer(by_part[p], np.int64)
        whole = np.log10(total + 0.5 * (distinct + 1))
        own = (np.log10(counts + 0.5) - whole)[number]
        end = np.log10(ends + 0.5) - whole
        n_words = np.diff(firsts)
        doc = np.repeat(np.arange(shard.n), n_words)
        every = nodes_of(shard.buffer)
        nodes, by_part = np.unique(every), {a["part"]: a["blob"] for a in answers or () if not a["word"]}
        log = np.zeros(len(nodes))
        for p, at, _ in C.blobs_by_part(C.part_of(C.mix(nodes), node_parts), node_parts):
            log[at] = np.frombuffer(by_part[p], np.float64)
        code = log[np.searchsorted(nodes, every)]
        yield {
            "doc_id": C.id_array(shard), "held_out": held_out(shard, folds, chosen), "n_tokens": n_words + 1,
            "n_known": np.bincount(doc, counts[number] > 0, shard.n).astype(np.int64) + (ends > 0),
            "train_tokens": np.full(shard.n, total), "base_score": np.bincount(doc, own, shard.n) + end,
            "score": np.add.reduceat(code, shard.offsets[:-1]),
        }

    own = answers.select("shard", F.lit(True).alias("word"), "part", F.col("counts").alias("blob"))
    both = own.unionByName(likely.select("shard", F.lit(False).alias("word"), "part", F.col("scores").alias("blob")))
    by_shard = both.groupBy("shard").agg(F.collect_list(F.struct("word", "part", "blob")).alias("answers"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return C.map_shards(shards.join(by_shard, "shard", "left"), score, schema, "answers")

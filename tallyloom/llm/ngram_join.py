"""Near duplicates by the Jaccard similarity of word shingles, joined by T-occurrence search (DivideSkip).

A document that is linked with R holds at least T of R's shingles, T following from the size of R alone. So its id
occurs in at least T of the inverted lists of R's shingles. Of these lists the L longest are set aside; the short ones
are merged, ids that occur in fewer than T - L of them are dropped, and the rest are probed in the long lists by binary
search.

To run this without ever listing a list whole, the same count is first used as a filter, exactly, over all documents:

1. Documents with equal shingle sets are one from here on.
2. A shingle that occurs once can't count. Documents with fewer than T shared shingles have no link.
3. What is left is searched in bounded blocks of documents with an equal minimum hash. The links found make clusters;
   this step may miss links, and only makes the next one small.
4. A link between two clusters needs T shingles that occur in another cluster. Documents with that many are split into
   the components of "share one of the rarest |R| - T + 1 of those shingles", which holds for any linked pair, and every
   component is searched completely, block against block.

Copies of a group are never paired with each other one by one: once two documents are in one cluster, a link between
them is of no more use.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C
from tallyloom.llm.components import connected_components
from tallyloom.session import release_staged, staged_tables

#: Documents searched against each other at a time, and bytes of their shingles.
BLOCK, BLOCK_BYTES = 256, 16 << 20
_DOCS = (1 << 20) - 1
_SEEDS = (0x51ED270B, 0x2545F491, 0x9E3779B9)


def needed(size: int, percent: int) -> int:
    """T: the least number of shingles shared with any linked document."""
    return max(1, -(-percent * size // 100))


def shingle_sets(shard: C.Shard, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    buffer = C.lower_table()[shard.buffer]
    starts, ends = C.words_of(buffer)
    hashes, firsts = C.run_hashes(buffer, starts, ends), C.firsts_of(starts, shard.offsets)
    every = C.shingle_hashes(hashes, words)
    sets = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(every[a : b - words + 1]))
        elif b > a:  # too short for a shingle: the sequence, marked with its length
            sets.append(C.mix(C.shingle_hashes(hashes[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def t_occurrence_links(sizes: np.ndarray, sets: list[np.ndarray], percent: int, group: np.ndarray) -> list[tuple[int, int]]:
    """Links that join all documents linked with each other, leaving out those inside a group known before.

    ``sizes`` are the sizes of the full sets; ``sets`` may lack shingles that no other document here holds.
    """
    n, group = len(sets), group.copy()
    values = np.concatenate(sets)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    doc = doc[order]
    lists, first, count = np.unique(values[order], return_index=True, return_counts=True)
    number = np.searchsorted(lists, values)  # list of each shingle, document by document
    key = np.repeat(np.arange(len(lists)), count) * n + doc  # ascending: list, then document
    bounds = np.cumsum([0, *(len(s) for s in sets)])
    links = []
    for r in range(n - 1):
        if not (group[r + 1 :] != group[r]).any():
            continue
        own = number[bounds[r] : bounds[r + 1]]
        own = own[np.argsort(count[own], kind="stable")]  # short lists first
        t = needed(int(sizes[r]), percent)
        if len(own) < t:
            continue
        longest = int(count[own[-1]])
        aside = min(t - 1, int(t / (0.0085 * math.log2(longest + 1) + 1)))
        short, long = own[: len(own) - aside], own[len(own) - aside :]
        length = count[short]
        at = np.repeat(first[short] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        found, seen = np.unique(doc[at], return_counts=True)  # the short lists in one merged run
        near = (found > r) & (seen >= t - aside) & (group[found] != group[r])
        near &= (sizes[found] * 100 >= percent * sizes[r]) & (sizes[r] * 100 >= percent * sizes[found])
        found, seen = found[near], seen[near]
        if not len(found):
            continue
        probes = (long[:, None] * n + found[None, :]).ravel()
        seen = seen + C.in_sorted(probes, key).reshape(len(long), len(found)).sum(0)
        linked = found[seen * (100 + percent) >= percent * (sizes[r] + sizes[found])]
        for s in linked.tolist():
            if group[s] != group[r]:
                links.append((r, s))
                group[group == group[s]] = group[r]
    return links


def _search(percent: int):
    """Links of one block, or of one block with another (``side`` 0 and 1: pairs within a side are left to their own block)."""

    def make(rows):
        if len(rows["ref"]) < 2:
            return
        refs = np.array(rows["ref"])
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        links = t_occurrence_links(np.array(rows["n"]), sets, percent, np.array(rows["label"]))
        if links:
            a, b = np.array(links).T
            yield {"a": refs[a], "b": refs[b]}

    return make


def _blocks(keyed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Search all pairs of documents with one key, block against block: ``keyed`` is ``ref, size, key, label, pairs``.

    With ``pairs`` false only documents of the same block meet.
    """
    many = keyed.groupBy("key").agg(F.count("*").alias("_n"), F.sum("size").alias("_size")).filter("_n > 1")
    blocks = F.ceil(F.greatest(F.col("_n") / BLOCK, F.col("_size") / BLOCK_BYTES))
    placed = keyed.join(many.withColumn("_blocks", blocks), "key").withColumn(
        "_block", F.pmod(F.xxhash64("ref"), F.col("_blocks"))
    )
    others = F.when(F.col("pairs"), F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).otherwise(F.array("_block"))
    placed = placed.withColumn("_other", F.explode(others)).select(
        "ref", "label", "key", F.least("_block", "_other").alias("i"), F.greatest("_block", "_other").alias("j")
    )
    return C.map_groups(placed.join(sets, "ref"), ["key", "i", "j"], _search(percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, ref, copies_of`` for every row of ``docs`` (``doc_id, text``, more columns are ignored).

    Words are runs without white space, A-Z lower-cased. A document with fewer than ``words`` words has its whole
    sequence as its one shingle. Null and empty texts have none and are linked with nothing. ``component_id`` is the
    smallest id that links reach; null if all those ids are null. Rows with equal ids are separate documents.
    ``ref`` numbers the rows of this call. Shingles are held as 64-bit hashes.
    """
    member = _members(*C.bucketed_shards(docs), words, percent)
    least = member.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return member.join(least, "group").select("doc_id", "n_shingles", "component_id", "ref", "copies_of")


def first_of_each_group(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id, of equal ids the first row.

    A row without an id stays only if no row of its group has one. Documents without words are groups of their own.
    """
    shards, buckets = C.bucketed_shards(docs, carry=True)
    member = _members(shards, buckets, words, percent)
    first = member.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ref")).alias("first"))
    places = first.select(F.shiftright("first.ref", 20).alias("shard"), F.col("first.ref").bitwiseAND(_DOCS).alias("row"))
    rows = C.to_buckets(places, buckets, F.collect_list("row").alias("rows"))
    return C.chosen_rows(shards.join(rows, "shard"), docs.schema, "rows")


def _members(shards: DataFrame, buckets: int, words: int, percent: int) -> DataFrame:
    """``ref, doc_id, n_shingles, copies_of, group`` of every document of the shards, staged."""
    mark = staged_tables()
    parts = C.parts_for(shards)

    def digests(shard):
        sets = shingle_sets(shard, words)
        sums = [(s.sum(), C.mix(s ^ np.uint64(0x5BD1E995)).sum()) for s in sets]
        yield {
            "ref": (shard.shard << 20) + np.arange(shard.n),
            "doc_id": C.id_array(shard),
            "n": [len(s) for s in sets],
            "s1": np.array([x for x, _ in sums], np.uint64).view(np.int64),
            "s2": np.array([x for _, x in sums], np.uint64).view(np.int64),
        }

    rows = C.staged(C.map_shards(shards, digests, "ref long, doc_id long, n long, s1 long, s2 long"))
    # Equal sets: the first row stands for all.
    distinct = rows.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("ref").alias("first"))
    distinct = C.staged(distinct)
    firsts = distinct.select(F.shiftright("first", 20).alias("shard"), F.col("first").bitwiseAND(_DOCS).alias("row"))
    chosen = C.to_buckets(firsts, buckets, F.sort_array(F.collect_list("row")).alias("chosen"))
    picked = shards.join(chosen, "shard")

    def shared_keys(shard, chosen):
        sets = shingle_sets(shard, words)
        return C.distinct_with_twice(np.concatenate([sets[i] for i in chosen]))

    flags = C.shared_flags(picked, shared_keys, parts, "chosen", buckets=buckets)

    def survivors(shard, chosen, answers):
        sets = shingle_sets(shard, words)
        every = np.unique(np.concatenate([sets[i] for i in chosen]))
        shared = every[C.read_flags(every, parts, answers)]
        out = []
        for i in chosen:
            kept = sets[i][C.in_sorted(sets[i], shared)]
            if len(kept) >= needed(len(sets[i]), percent):
                out.append(((shard.shard << 20) + i, len(sets[i]), kept.tobytes(), *(C.mix(kept ^ np.uint64(s)).min().view(np.int64) for s in _SEEDS)))
        if out:
            ref, n, blob, *least = zip(*out, strict=True)
            yield {"ref": ref, "n": n, "shingles": blob} | {f"least{j}": np.array(x) for j, x in enumerate(least)}

    columns = "ref long, n long, shingles binary, " + ", ".join(f"least{j} long" for j in range(len(_SEEDS)))
    held = C.staged(C.map_shards(picked.join(flags, "shard"), survivors, columns, "chosen", "answers"))
    sets = held.select("ref", "n", "shingles")

    # Clusters from blocks with equal minimum hashes.
    size = F.length("shingles").alias("size")
    keyed = held.select("ref", size, F.explode(F.array(*(F.xxhash64(F.lit(j), F.col(f"least{j}")) for j in range(len(_SEEDS))))).alias("key"))
    found = C.staged(_blocks(keyed.withColumn("label", F.col("ref")).withColumn("pairs", F.lit(False)), sets, percent))
    clusters = C.staged(connected_components(found))
    labelled = sets.join(clusters.withColumnRenamed("node", "ref"), "ref", "left").withColumn("label", F.coalesce("component", "ref")).drop("component")
    linked = found.unionByName(_between_clusters(C.staged(labelled), percent))

    joined = connected_components(linked).select(F.col("node").alias("first"), "component")
    member = rows.join(distinct, ["n", "s1", "s2"], "left").join(joined, "first", "left")
    member = C.staged(member.select("ref", "doc_id", F.col("n").alias("n_shingles"), F.col("first").alias("copies_of"), F.coalesce("component", "first", "ref").alias("group")))
    release_staged(shards.sparkSession, mark, staged_tables() - 1)  # all that led to it
    return member


def _between_clusters(held: DataFrame, percent: int) -> DataFrame:
    """All links between documents of different clusters, as far as they join clusters; ``held``: ``ref, n, shingles, label``."""
    total = held.agg(F.sum(F.length("shingles"))).first()[0] or 0
    parts = int(max(4, total // (2 << 20)))
    packed = held.groupBy(F.shiftright("ref", 20).alias("shard")).agg(F.sort_array(F.collect_list(F.struct("ref", "n", "label", "shingles"))).alias("docs"))
    packed = C.staged(packed)

    def entries(docs):
        """Distinct (shingle, cluster) of a shard, in order."""
        values = np.concatenate([np.frombuffer(d["shingles"], np.uint64) for d in docs])
        label = np.repeat(np.array([d["label"] for d in docs]), [len(d["shingles"]) // 8 for d in docs])
        order = np.lexsort((label, values))
        values, label = values[order], label[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (label[1:] != label[:-1])
        return values[new], label[new]

    ask_schema = "part long, shard long, shingles binary, labels binary"
    fields = C.pa_schema(ask_schema)

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, label = entries(row["docs"])
                made = [(p, *blobs) for p, _, blobs in C.blobs_by_part(C.part_of(values, parts), parts, values, label)]
                part, shingles, labels = zip(*made, strict=True)
                yield C.record_batch({"part": part, "shard": [row["shard"]] * len(part), "shingles": shingles, "labels": labels}, fields)

    def answer(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        values, label = np.concatenate(blobs), np.concatenate([np.frombuffer(x, np.int64) for x in table.column("labels").to_pylist()])
        order = np.lexsort((label, values))
        v, w = values[order], label[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
        heads, inverse = np.unique(v, return_inverse=True)
        clusters = np.empty(len(v), np.uint32)
        clusters[order] = np.bincount(inverse, new, len(heads)).astype(np.uint32)[inverse]
        ends = np.cumsum([0, *map(len, blobs)])
        return pa.table({"part": table.column("part"), "shard": table.column("shard"), "clusters": pa.array([clusters[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())})

    asked = packed.mapInArrow(ask, ask_schema)
    answers = asked.groupBy("part").applyInArrow(answer, "part long, shard long, clusters binary")
    by_shard = answers.groupBy("shard").agg(F.collect_list(F.struct("part", "clusters")).alias("answers"))

    out_schema = "ref long, n long, label long, shingles binary, prefix binary"
    out_fields = C.pa_schema(out_schema)

    def open_documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, _ = entries(row["docs"])
                clusters = np.zeros(len(values), np.uint32)
                by_part = {a["part"]: a["clusters"] for a in row["answers"]}
                for p, at, _ in C.blobs_by_part(C.part_of(values, parts), parts):
                    clusters[at] = np.frombuffer(by_part[p], np.uint32)
                heads, first = np.unique(values, return_index=True)
                spread, out = clusters[first], []
                for d in row["docs"]:
                    own = np.frombuffer(d["shingles"], np.uint64)
                    rarity = spread[np.searchsorted(heads, own)]
                    own, rarity = own[rarity > 1], rarity[rarity > 1]
                    t = needed(d["n"], percent)
                    if len(own) >= t:
                        rare = np.lexsort((own, rarity))[: len(own) - t + 1]
                        out.append((d["ref"], d["n"], d["label"], own.tobytes(), own[rare].tobytes()))
                if out:
                    yield C.record_batch(dict(zip(out_fields.names, zip(*out, strict=True), strict=True)), out_fields)

    open_docs = C.staged(packed.join(by_shard, "shard").mapInArrow(open_documents, out_schema))

    post_fields = C.pa_schema("ref long, shingle long")

    def postings(batches):
        for batch in batches:
            for row in batch.to_pylist():
                prefix = np.frombuffer(row["prefix"], np.int64)
                yield C.record_batch({"ref": np.full(len(prefix), row["ref"]), "shingle": prefix}, post_fields)

    posted = open_docs.select("ref", "prefix").mapInArrow(postings, "ref long, shingle long")
    heads = posted.groupBy("shingle").agg(F.min("ref").alias("head"), F.count("*").alias("_n")).filter("_n > 1")
    edges = posted.join(heads, "shingle").select(F.col("ref").alias("a"), F.col("head").alias("b")).distinct()
    candidates = connected_components(edges)
    keyed = open_docs.select("ref", "label", F.length("shingles").alias("size")).join(candidates.select(F.col("node").alias("ref"), F.col("component").alias("key")), "ref")
    return _blocks(keyed.withColumn("pairs", F.lit(True)), open_docs.select("ref", "n", "shingles"), percent)

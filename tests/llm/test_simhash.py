"""SimHash fingerprints and their components against plain re-statements."""

import random

import cases
import numpy as np
import pytest
import xxhash

from tallyloom.llm import queries, simhash

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    found = cases.words(cases.lower(text or ""))
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits, distance=4):
    """Position of the smallest fingerprint that links reach, by comparing every pair."""
    values = np.array(bits, np.uint64)
    label, open_ = list(range(len(bits))), set(range(len(bits)))
    for i in range(len(bits)):
        if i not in open_:
            continue
        todo = [i]
        open_.discard(i)
        while todo:
            j = todo.pop()
            label[j] = i
            near = set(np.flatnonzero(np.bitwise_count(values ^ values[j]) <= distance).tolist()) & open_
            open_ -= near
            todo += near
    return label


def expected(rows):
    bits = [plain_fingerprint(text) for _, text in rows]
    label = plain_components(bits)
    least = {}
    for (key, _), group in zip(rows, label, strict=True):
        if key is not None:
            least[group] = min(key, least.get(group, key))
    return sorted(((key, f"{b:016x}", least.get(group)) for (key, _), b, group in zip(rows, bits, label, strict=True)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_documents(docs, rows):
    assert got(simhash.near_duplicates(docs)) == expected([r[:2] for r in rows])


def test_query_equals_plain_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got(queries.QUERIES["op12_simhash"](spark, SF_DIR)) == expected(rows)


def test_empty_table(nothing):
    found = simhash.near_duplicates(nothing)
    assert found.count() == 0 and found.columns == ["doc_id", "fingerprint", "component_id"]


def test_every_close_pair_has_a_chain():
    """Some start passes for each difference of at most 4 bits, and no start for others."""
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 4, 5, 6, 9] * 300:
        difference = np.full(16, sum(1 << b for b in rng.sample(range(64), n)), np.uint64)
        assert (len(simhash.chain_holds(difference, np.arange(16))) > 0) == (n <= 4)


def crowd(seed, centres, around):
    rng = random.Random(seed)
    bits = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(around):
            bits.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))))
    return sorted(bits)


@pytest.mark.parametrize("block", [3, 40, 4096])
def test_crowded_keys_lose_no_link(spark, block):
    """Dense groups, whole or cut into blocks: the same components as from all pairs."""
    bits = crowd(block, 3, 150) + [0, (1 << 64) - 1, 15]
    df = spark.createDataFrame([(b - (1 << 64) if b >> 63 else b,) for b in bits], "bits long")
    joined = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df, block).collect()}
    at, parent = {b: i for i, b in enumerate(bits)}, list(range(len(bits)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in joined:
        x, y = root(at[a]), root(at[b])
        parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(bits))] == plain_components(bits)


def test_bits_follow_the_definition():
    rng = random.Random(8)
    for n in (1, 3, 4, 5, 60):
        text = cases.sentence(rng, n, ["Ab", "é", "C", "日本"])
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n\x0b") == 0
    long = cases.sentence(rng, 40000, ["a", "b", "cc", "d"])
    assert simhash.fingerprint(long.encode()) == plain_fingerprint(long)

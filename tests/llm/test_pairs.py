"""Operators on documents that share text: near duplicates, repeated strings and windows, benchmark passages."""

import random
import re
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import common as C
from tallyloom.llm import fm_index, ngram_join, suffix_dedup, superkmers
from tallyloom.llm.components import connected_components
from tallyloom.session import release_staged, staged_tables


def test_words_are_those_of_the_pattern():
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("ab é\t\n\x0b\x1c日 \x85\xa0Z") for _ in range(rng.randint(0, 60)))
        raw = np.frombuffer(text.encode() + b"\xff", np.uint8)
        starts, ends = C.words_of(raw)
        assert [raw[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == cases.words(text)


def test_window_minima_and_spans():
    rng = np.random.default_rng(1)
    for _ in range(40):
        values = rng.integers(0, 9, rng.integers(1, 40))
        width = int(rng.integers(1, 12))
        assert C.window_minima(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
    starts, ends = C.merge_spans(np.array([5, 0, 2, 9]), np.array([7, 3, 5, 11]))
    assert (starts.tolist(), ends.tolist()) == ([0, 9], [7, 11])


def test_shards_hold_whole_rows(docs, rows):
    shards = C.shards_of(docs, 5000)
    assert shards.count() > 3
    found = [(i if known else None, shard.text(k)) for s in shards.collect() for shard in [C.unpack(s.shard, s.payload)] for k, (i, known) in enumerate(zip(shard.ids.tolist(), shard.known.tolist(), strict=True))]
    assert Counter(found) == Counter((r[0], (r[1] or "").encode()) for r in rows)


@pytest.mark.parametrize("operator", [superkmers.remove_repeats, ngram_join.first_of_each_group])
def test_staged_texts_stay_where_they_are(spark, docs, operator, monkeypatch):
    """What is known of the shards is shuffled to them, never the shards; nothing stays in the catalog."""
    plans, before, staged, threshold = [], staged_tables(), C.staged, "spark.sql.autoBroadcastJoinThreshold"
    explained = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    monkeypatch.setattr(C, "staged", lambda df: (plans.append(df._jdf.queryExecution().explainString(explained)), staged(df))[1])
    monkeypatch.setattr(C, "BUCKET_BYTES", 10000)
    least = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plans.append(operator(docs)._jdf.queryExecution().explainString(explained))
    finally:
        spark.conf.set(threshold, least)
    assert any("payload" in plan for plan in plans)
    assert not [plan for plan in plans if re.search(r"\) Exchange\nInput[^\n]*payload", plan)]
    release_staged(spark, before)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


@pytest.mark.parametrize("seed", range(4))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 160)] + [(7, 7), (99, 99), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in list(parent)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_groups(rows):
    sets = [cases.shingles(r[1]) for r in rows]
    root = cases.groups(sets)
    least = {}
    for r, g in zip(rows, root, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return sets, root, least


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates_equal_all_pairs(docs, rows, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    sets, root, least = expected_groups(rows)
    got = ngram_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((r[0], len(s), least.get(g)) for r, s, g in zip(rows, sets, root, strict=True))


def test_links_missed_by_equal_minima_are_found(docs, rows, monkeypatch):
    """The complete step alone: without any cluster from minimum hashes."""
    monkeypatch.setattr(ngram_join, "_SEEDS", (0x51ED270B,))
    sets, root, least = expected_groups(rows)
    got = ngram_join.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((r[0], least.get(g)) for r, g in zip(rows, root, strict=True))


def test_t_occurrence_search_equals_pairs():
    rng = np.random.default_rng(5)
    for _ in range(30):
        base = rng.integers(0, 1 << 60, 60).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(20, 60), replace=False), rng.integers(0, 1 << 60, rng.integers(0, 12)).astype(np.uint64)])) for _ in range(12)]
        sizes = np.array([len(s) for s in sets])
        links = ngram_join.t_occurrence_links(sizes, sets, 75, np.arange(12))
        group = list(range(12))
        for a, b in links:
            group = [group[a] if g == group[b] else g for g in group]
        root = cases.groups([set(s.tolist()) for s in sets])
        assert len({*zip(group, root, strict=True)}) == len(set(group)) == len(set(root))


def test_one_of_each_group_stays(docs, rows):
    _, root, least = expected_groups(rows)
    kept = ngram_join.first_of_each_group(docs)
    assert kept.columns == docs.columns
    expected, taken = Counter(), set()
    for r, g in sorted(zip(rows, root, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if g not in taken:
            expected[r[0], r[1]] += 1
            taken.add(g)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == expected


def test_near_duplicates_of_nothing(nothing):
    assert ngram_join.near_duplicates(nothing).count() == 0
    assert ngram_join.first_of_each_group(nothing).count() == 0


@pytest.mark.parametrize("depth", [400])
def test_two_stage_order_is_the_order_of_suffixes(depth):
    rng = np.random.default_rng(1)
    for _ in range(60):
        text = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 250)).astype(np.uint8)
        raw = text.tobytes()
        order = suffix_dedup.two_stage_suffix_array(text, depth).tolist()
        assert order == sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize(("length", "crowd"), [(400, 8 << 20), (75, 8 << 20), (64, 1)])
def test_repeated_bytes_equal_all_strings(docs, rows, monkeypatch, length, crowd):
    monkeypatch.setattr(suffix_dedup, "SORT_LIMIT", crowd)
    gone = cases.repeated_bytes([r[1] for r in rows], length)
    expected = Counter()
    for r, g in zip(rows, gone, strict=True):
        raw = (r[1] or "").encode()
        kept = bytes(b for b, x in zip(raw, g, strict=True) if not x)
        expected[r[0], len(raw), sum(g), len(re.findall(b"\1+", g)), cases.sha(kept)] += 1
    got = suffix_dedup.without_repeats(docs, length)
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_short_periodic_texts_are_no_copies_of_themselves(spark):
    """Texts of one period, of 400 to 800 bytes, alone and in pairs that share some windows only."""
    rng = random.Random(12)
    texts = []
    for n in (400, 401, 402, 414, 444, 459, 505, 640, 767, 799, 800):
        for period in (1, 3, 7, 60, 123, 397, 399):
            motif = cases.sentence(rng, 400, ["Of", "a", "zu"])[:period]
            texts += [(motif * 900)[:n], "start of text %d " % n + (motif * 900)[: n - rng.randrange(40)]]
    rng.shuffle(texts)
    for chosen in (texts[:40], texts[40:41], texts[41:]):
        gone = cases.repeated_bytes(chosen, 400)
        found = suffix_dedup.without_repeats(spark.createDataFrame(list(enumerate(chosen)), "doc_id long, text string"))
        assert {r.doc_id: r.n_removed for r in found.collect()} == {i: sum(g) for i, g in enumerate(gone)}


def test_repeated_bytes_of_nothing(nothing):
    assert suffix_dedup.without_repeats(nothing).count() == 0


def test_repeated_windows_equal_all_windows(docs, rows):
    expected = Counter()
    for i, (found, gone) in cases.without_windows(rows).items():
        kept = [w for w, g in zip(found, gone, strict=True) if not g]
        expected[rows[i][0], len(found), sum(gone), cases.sha(" ".join(kept))] += 1
    assert Counter(tuple(r) for r in superkmers.without_repeats(docs).collect()) == expected


def test_texts_without_repeats_keep_their_words(docs, rows):
    expected = Counter((rows[i][0], tuple(w for w, g in zip(*x, strict=True) if not g)) for i, x in cases.without_windows(rows).items())
    got = superkmers.remove_repeats(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert Counter((r.doc_id, tuple(cases.words(r.text))) for r in found) == expected
    assert all(r.n_chars == len(r.text or "") and r.payload in ("p", None) for r in found)


def test_repeated_windows_of_nothing(nothing):
    assert superkmers.without_repeats(nothing).count() == 0
    assert superkmers.remove_repeats(nothing).count() == 0


def test_suffix_order_of_numbers():
    rng = np.random.default_rng(2)
    for top in (2, 5, 1 << 22):
        for _ in range(30):
            text = rng.integers(0, top, rng.integers(0, 120))
            assert fm_index.suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_index_finds_every_place():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 6, 3000)
    index = fm_index.FMIndex(text, 5)
    for _ in range(50):
        m = int(rng.integers(1, 6))
        phrase = rng.integers(0, 6, m)
        low, high = index.search(phrase[None, :], np.array([m]))
        places = [i for i in range(len(text) - m + 1) if (text[i : i + m] == phrase).all()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == places


ITEM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def benchmark(spark, rows):
    long = next(r[1] for r in rows if r[1] and len(r[1]) > 5000)
    items = [(1, " ".join(long.split(" ")[100:125])), (2, "one, TWO"), (10, "w1 w2 w3 never seen"), (11, None), (12, ""), (None, "one two"), (13, "..."), (2, "one two three four"), (14, " ".join(long.split(" ")[110:135]))]
    return items, spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, shard string")


@pytest.mark.parametrize("phrases", [100_000, 5])
def test_contamination_equals_search_of_words(spark, docs, rows, monkeypatch, phrases):
    monkeypatch.setattr(fm_index, "PHRASES", phrases)
    items, table = benchmark(spark, rows)
    windows = set()
    for item, text in items:
        found = ITEM.findall(cases.lower(text or ""))
        if item is not None and found:
            k = min(10, len(found))
            windows |= {(item, tuple(found[i : i + k])) for i in range(len(found) - k + 1)}
    expected = Counter()
    for r in rows:
        found = ITEM.findall(cases.lower(r[1] or ""))
        hit, ids = set(), set()
        for item, w in windows:
            for i in range(len(found) - len(w) + 1):
                if tuple(found[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    ids.add(item)
        expected[r[0], len(found), len(hit), len(ids), cases.sha(",".join(sorted(map(str, ids)))), bool(hit)] += 1
    assert Counter(tuple(r) for r in fm_index.contamination(docs, table).collect()) == expected


def test_hits_are_cut_out(spark, docs, rows):
    _, table = benchmark(spark, rows)
    got = fm_index.remove_hits(docs, table)
    assert got.columns == docs.columns and got.count() == len(rows)
    assert fm_index.contamination(got, table).agg(F.sum("n_hit")).first()[0] <= 2  # words that meet anew where a span was


def test_contamination_of_nothing(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.contamination(nothing, none).count() == 0
    assert not fm_index.contamination(docs, none).agg(F.max("contaminated")).first()[0]

"""Passages in documents against a search for their text, and what the plan reads."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import passages

SCHEMA = "id string, text string"


def tables(spark, docs, wanted):
    return [spark.createDataFrame([(f"{side}{i}", t) for i, t in enumerate(texts)], SCHEMA) for side, texts in (("d", docs), ("b", wanted))]


def expected(docs, wanted):
    return sorted((f"d{i}", f"b{j}") for i, d in enumerate(docs) for j, w in enumerate(wanted) if d and w and w in d)


def found(spark, docs, wanted):
    return sorted(tuple(r) for r in passages.containing(*tables(spark, docs, wanted)).collect())


@pytest.mark.parametrize("seed", range(3))
def test_passages_of_every_size(spark, seed):
    """Cut out of documents at any place: one character, words, whole documents, and texts that are in none."""
    rng = random.Random(seed)
    alphabet = "ab é日\n."
    docs = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 40, 200, 700]))) for _ in range(40)] + [None, "", "aaaa" * 60, "ab" * 300]
    wanted = [None, "", "zz"]
    for size in [1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 31, 32, 33, 63, 64, 65, 90, 200, 700]:
        for _ in range(4):
            doc = rng.choice([d for d in docs if d and len(d) >= min(size, 200)])
            at = rng.randrange(max(1, len(doc) - size + 1))
            wanted.append(doc[at : at + size])
    wanted += [w[:-1] + "#" for w in wanted[-20:]] + ["a" * 50, "ba" * 40]
    assert found(spark, docs, wanted) == expected(docs, wanted)


def test_texts_longer_than_a_slice(spark):
    """Passages across the borders of the slices that are hashed together, and across no border of documents."""
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(passages._SLICE * 2 + 500))
    cuts = [passages._SLICE + d for d in (-100, -64, -63, -33, -1, 0, 1)] + [len(long) - 80, 0]
    docs = [long[:70], long, long[70:200], "x" + long[5000:]]
    wanted = [long[c : c + n] for c in cuts for n in (20, 64, 100)] + [long[40:110]]
    assert found(spark, docs, wanted) == expected(docs, wanted)


def test_a_passage_of_most_documents(spark):
    docs = [f"{i} the same line in all of these documents, of more than some bytes {i}" for i in range(300)]
    wanted = ["the same line in all of these documents, of more than some bytes", "the same line", "299"]
    assert found(spark, docs, wanted) == expected(docs, wanted)


def test_ids_of_any_type_and_empty_tables(spark):
    docs, wanted = (spark.createDataFrame(rows, "id long, text string, a_id string") for rows in ([(5, "one two three", "x")], [(7, "two", "y"), (8, "ten", "y")]))
    assert [tuple(r) for r in passages.containing(docs, wanted).collect()] == [(5, 7)]
    assert passages.containing(docs.limit(0), wanted).count() == 0
    assert passages.containing(docs, wanted.limit(0)).count() == 0


def test_only_candidates_are_read_as_text(spark):
    docs, wanted = tables(spark, ["nothing here to be found at all"] * 500 + ["a long enough passage is in this one"], ["a long enough passage"])
    assert passages.candidates(docs, wanted).count() == 1
    plan = passages.containing(docs, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and "Generate" not in plan


def test_filter_lets_wanted_anchors_through(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("int").alias("_class"), F.xxhash64("id").alias("_anchor"))
    import numpy as np

    built = passages._Filter(df)
    for k in range(3):
        own = np.array([r._anchor for r in df.filter(F.col("_class") == k).collect()], np.int64).view(np.uint64)
        assert built.may_hold(k, own).all()
        assert built.may_hold(k, np.random.default_rng(k).integers(0, 1 << 63, 20000).astype(np.uint64)).mean() < 0.15

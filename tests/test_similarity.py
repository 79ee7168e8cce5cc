"""Similar pairs and totals against all pairs computed in plain Python."""

import math
import random
from collections import Counter

import pytest

from tallyloom.plans import similarity, weights


def random_docs(prefix, count, seed):
    """Texts over a small vocabulary: a hot word in most, many exact copies, some without words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(count):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=rng.randint(1, 12))
        docs.append((f"{prefix}{i}", " ".join(words + ["hot"] * rng.randint(0, 2))))
    docs += [(f"{prefix}c{i}", "copied text with hot w3 w9") for i in range(count // 3)]
    return docs + [(f"{prefix}e", "the a !!")]


@pytest.fixture(scope="module")
def sources(spark):
    a, b = random_docs("a", 60, 1), random_docs("b", 40, 2)
    schema = "id string, text string"
    a_df, b_df = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    idf = weights.inverse_document_frequency(a_df.unionByName(b_df))
    return a, b, a_df, b_df, idf


@pytest.fixture(scope="module")
def expected(sources):
    a, b, *_ = sources
    stop = {"the", "a", "with"}
    tokens = {i: [t for t in text.split() if t.isalnum() and t not in stop] for i, text in a + b}
    holders = Counter(t for words in tokens.values() for t in set(words))
    vector = {
        i: {t: n / len(words) * len(tokens) / holders[t] for t, n in Counter(words).items()}
        for i, words in tokens.items()
    }
    norm = {i: math.sqrt(sum(w * w for w in v.values())) for i, v in vector.items()}

    def cosine(x, y):
        if not norm[x] or not norm[y]:
            return 0.0
        return sum(w * vector[y].get(t, 0.0) for t, w in vector[x].items()) / norm[x] / norm[y]

    return {(x, y): cosine(x, y) for x, _ in a for y, _ in b}


@pytest.mark.parametrize("least", [0.05, 0.3, 0.8])
def test_similar_pairs_are_exactly_those_above_the_bound(sources, expected, least):
    a, b, a_df, b_df, idf = sources
    texts = {}
    for side in (a, b):
        for i, text in side:
            texts.setdefault((side is a, text), []).append(i)
    members = {min(ids, key=lambda i: int("".join(filter(str.isdigit, i)) or 0)): ids for ids in texts.values()}
    found = {}
    own = {(r.a_id, r.b_id): r.similarity for r in similarity.similar_pairs(a_df, b_df, None, least).collect()}
    for row in similarity.similar_pairs(a_df, b_df, idf, least).collect():
        assert abs(own.pop((row.a_id, row.b_id)) - row.similarity) < 1e-9
        assert (row.a_copies, row.b_copies) == (len(members[row.a_id]), len(members[row.b_id]))
        for x in members[row.a_id]:
            for y in members[row.b_id]:
                assert (x, y) not in found
                found[x, y] = row.similarity
    wanted = {pair for pair, score in expected.items() if score >= least}
    assert set(found) == wanted and not own
    assert all(abs(score - expected[pair]) < 1e-9 for pair, score in found.items())


def test_candidates_are_few(sources, expected):
    """Bounds by shared tokens: few candidates that are not similar, and none missing."""
    _, _, a_df, b_df, idf = sources
    for least in (0.3, 0.6):
        index = similarity.similarity_index(a_df, b_df, idf, least)
        found = {(r.a_id.id, r.b_id.id) for r in similarity.candidate_pairs(*index, least).collect()}
        similar = {(r.a_id, r.b_id) for r in similarity.similar_pairs(a_df, b_df, idf, least).collect()}
        assert similar <= found and len(found) <= 3 * len(similar)


def test_bound_must_be_positive(sources):
    _, _, a_df, b_df, idf = sources
    with pytest.raises(ValueError):
        similarity.similar_pairs(a_df, b_df, idf, 0.0)


def test_totals_need_no_pairs(sources, expected):
    _, _, a_df, b_df, idf = sources
    total = similarity.all_pairs_total(a_df, b_df, idf).first()
    assert total.pairs == len(expected)
    assert abs(total.similarity_sum - sum(expected.values())) < 1e-9
    assert abs(total.similarity_mean - sum(expected.values()) / len(expected)) < 1e-12


@pytest.mark.parametrize("frequent", [1, 7, 1000])
def test_totals_with_few_and_many_broadcast_tokens(sources, expected, frequent):
    _, _, a_df, b_df, idf = sources
    total = similarity.all_pairs_total(a_df, b_df, idf, frequent=frequent).first()
    assert total.pairs == len(expected)
    assert abs(total.similarity_sum - sum(expected.values())) < 1e-9


def test_evaluation(spark, sources, expected):
    _, _, a_df, b_df, idf = sources
    gold = [pair for pair in expected if pair[0][1:] == pair[1][1:] and pair[0][1:] != "e"]
    gold_df = spark.createDataFrame(gold + [("unknown", "b1")], "a_id string, b_id string")
    result = similarity.evaluate(a_df, b_df, gold_df, idf).first()
    rest = [score for pair, score in expected.items() if pair not in set(gold)]
    assert result.duplicates == len(gold)
    assert abs(result.mean_duplicates - sum(expected[p] for p in gold) / len(gold)) < 1e-9
    assert abs(result.mean_others - sum(rest) / len(rest)) < 1e-9


def test_requested_pairs(spark, sources, expected):
    _, _, a_df, b_df, idf = sources
    wanted = [("a1", "b1"), ("a1", "b2"), ("ac1", "bc1"), ("ae", "b1"), ("a1", "b1")]
    pairs = spark.createDataFrame(wanted, "a_id string, b_id string")
    rows = similarity.pair_cosines(pairs, a_df, b_df, idf).collect()
    assert len(rows) == len(wanted)
    for row in rows:
        if row.a_id == "ae":
            assert row.similarity is None
        else:
            assert abs(row.similarity - expected[row.a_id, row.b_id]) < 1e-9


def test_every_copy_is_listed(sources):
    a, _, a_df, *_ = sources
    rows = {r.id: (r.first_id, r.copies) for r in similarity.representatives(a_df).collect()}
    texts = {}
    for i, text in a:
        texts.setdefault(text, []).append(i)
    assert set(rows) == {i for i, _ in a}
    for ids in texts.values():
        assert len({rows[i] for i in ids}) == 1
        assert rows[ids[0]][0] in ids and rows[ids[0]][1] == len(ids)


def test_gold_pairs_of_any_copies_are_taken_away(spark, sources, expected):
    a, b, a_df, b_df, idf = sources
    gold = [("ac3", "bc2"), ("ac4", "bc2"), ("ac0", "bc0"), ("a1", "b1"), ("nobody", "b1")]
    gold_df = spark.createDataFrame(gold, "a_id string, b_id string")
    similar = similarity.similar_pairs(a_df, b_df, idf, 0.05)
    rows = similarity.other_pairs(similar, gold_df, a_df, b_df).collect()
    wanted = {pair for pair, score in expected.items() if score >= 0.05} - set(gold)
    assert sum(r.pairs for r in rows) == len(wanted)


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_passages_of_any_length_are_found(spark, n):
    """As a search for the text, with first and last words cut in the document."""
    from tallyloom.catalog.tables import containing

    words = "we say hello brave world today and more, again hello".split(" ")
    docs = [("d1", " ".join(words)), ("d2", "othello braver new worlds"), ("d3", "Hello  Brave"), ("d4", None), ("d5", ""), ("d6", "..,")]
    texts = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] + ["llo brave", "ello brave worl", "o", "", None, ".,", " ", "  Brave"]
    passages = [(f"b{i}", t) for i, t in enumerate(texts)]
    schema = "id string, text string"
    found = containing(spark.createDataFrame(docs, schema), spark.createDataFrame(passages, schema)).collect()
    wanted = {(d, p) for d, text in docs for p, t in passages if text and t and t in text}
    assert sorted(map(tuple, found)) == sorted(wanted)

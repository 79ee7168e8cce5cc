import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog.texts import file_line_count
from tallyloom.functions.text import STOPWORDS, content_tokens, normalize_text, split_words, word_tokens
from tallyloom.plans import similarity, weights, words
from tallyloom.sources.text import lines_of, read_lines, read_words


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_normalize(spark):
    assert one(spark, normalize_text, "Hi, you!") == "hi you"
    assert one(spark, normalize_text, " No under_score! ") == "no underscore"
    assert one(spark, normalize_text, " The Elephant's 4 cats. ") == "the elephants 4 cats"
    assert one(spark, normalize_text, "élan Ünïcode K") == "lan ncode"


def test_split_words_keeps_empty_ones(spark):
    assert one(spark, split_words, "a  b ") == ["a", "", "b", ""]
    assert one(spark, split_words, "") == [""]


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("A quick brown fox jumps over the lazy dog.", "a quick brown fox jumps over the lazy dog".split()),
        (" ", []),
        ("", []),
        ("!!!!123A/456_B/789C.123A", ["123a", "456_b", "789c", "123a"]),
        ("fox fox", ["fox", "fox"]),
        ("xKy", ["x", "y"]),
    ],
)
def test_word_tokens(spark, text, tokens):
    assert one(spark, word_tokens, text) == tokens


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("Why a the?", []),
        ("Being at the_?", ["the_"]),
        ("A quick brown fox jumps over the lazy dog.", ["quick", "brown", "fox", "jumps", "lazy", "dog"]),
    ],
)
def test_content_tokens(spark, text, tokens):
    assert one(spark, content_tokens, text) == tokens


def test_stopwords_are_few_and_distinct():
    assert len(STOPWORDS) == len(set(STOPWORDS)) < 200
    assert {"why", "a", "the", "being", "at", "over"} <= set(STOPWORDS)


def test_word_count_on_words(spark):
    lines = spark.createDataFrame([("cat elephant",), ("rat  rat cat",)], "line string")
    found = words.nonempty_words(lines)
    assert {(r.word, r.n) for r in words.word_count(found).collect()} == {("cat", 2), ("elephant", 1), ("rat", 2)}
    mean = words.mean_uses(found).first()
    assert (mean.total, mean.uniques, round(mean["mean"], 2)) == (5, 3, 1.67)
    assert [r.word for r in words.top_words(lines, 2).collect()] == ["cat", "rat"]


def test_lines_of_counts_empty_lines(spark):
    docs = spark.createDataFrame([(1, "a\n\nb"), (2, ""), (3, None)], "doc_id int, text string")
    assert [tuple(r) for r in lines_of(docs).orderBy("doc_id", "line_no").collect()] == [
        (1, 0, "a"), (1, 1, ""), (1, 2, "b"), (2, 0, "")
    ]


def test_readers(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "r.gz", "wt") as file:
        file.write("1::2::3::4\n" * 50)
    lines = read_lines(spark, str(tmp_path / "r.gz"), 4)
    assert lines.columns == ["line"] and lines.count() == 50 and lines.rdd.getNumPartitions() == 4
    (tmp_path / "w.txt").write_text("the\na\nthe\n")
    listed = read_words(spark, str(tmp_path / "w.txt"))
    tokens = spark.createDataFrame([("the",), ("fox",), ("fox",)], "token string")
    assert [r.token for r in weights.without_words(tokens, listed).collect()] == ["fox", "fox"]


def test_term_frequency(spark):
    docs = spark.createDataFrame([("x", "one_ one_ two!"), ("y", "")], "id string, text string")
    assert {(r.id, r.token): r.tf for r in weights.term_frequency(docs).collect()} == {
        ("x", "one_"): 2 / 3, ("x", "two"): 1 / 3
    }
    assert {r.id: r.n_tokens for r in weights.token_totals(docs).collect()} == {"x": 3, "y": 0}


def test_parts_of_texts_grow_with_their_bytes(spark):
    def texts(n):
        return spark.range(n).select(F.concat(F.lit("d"), "id").alias("id"), F.repeat(F.lit("word "), 200_000).alias("text"))

    def tasks(n):
        found = weights.term_frequency(texts(n))
        assert found.count() == n
        return found.rdd.getNumPartitions()

    assert tasks(1) == 2
    assert tasks(100) >= 11 and tasks(200) >= 23
    assert weights.text_parts(texts(3).select("id", F.lit(None).cast("string").alias("text"))) == 2


def test_inverse_document_frequency_has_no_logarithm(spark):
    docs = spark.createDataFrame([("x", "cat cat dog"), ("y", "cat"), ("z", "")], "id string, text string")
    idf = {r.token: r.idf for r in weights.inverse_document_frequency(docs).collect()}
    assert idf == {"cat": 1.5, "dog": 3.0}


VECTOR_A = [("a", "foo", 2.0, 1.0), ("a", "bar", 3.0, 1.0), ("a", "baz", 5.0, 1.0)]
VECTOR_B = [("b", "foo", 1.0, 1.0), ("b", "bar", 0.0, 1.0), ("b", "baz", 20.0, 1.0)]
WEIGHTS = "id string, token string, weight double, idf double"


def test_vectors(spark):
    a, b = spark.createDataFrame(VECTOR_A, WEIGHTS), spark.createDataFrame(VECTOR_B, WEIGHTS)
    pairs = spark.createDataFrame([("a", "b"), ("a", "none")], "a_id string, b_id string")
    dots = {r.b_id: r.dot for r in similarity.dot_products(pairs, a, b).collect()}
    assert dots == {"b": 102.0, "none": 0.0}
    assert abs(weights.norms(a).first().norm - 6.16441400297) < 1e-9
    cosine = {r.b_id: r.similarity for r in similarity.cosines(pairs, a, b).collect()}
    assert abs(cosine["b"] - 102 / math.sqrt(38) / math.sqrt(401)) < 1e-12
    assert cosine["none"] is None


def test_staged_tables_are_released(spark, tmp_path):
    from tallyloom.session import checkpoint_folder, stage_table, staging
    import os

    folder = checkpoint_folder(spark)
    before = set(os.listdir(folder))
    with staging(spark):
        assert stage_table(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_lines_with_carriage_returns_are_counted(spark, tmp_path):
    texts = ["one\r\ntwo\r\n", "one\rtwo\nthree", "one"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.line: r.n for r in file_line_count(spark, str(tmp_path)).collect()}
    assert got == Counter(line for text in texts for line in text.split("\n"))

"""Cosine similarity between two sources of documents and its evaluation.

Sources are tables with ``id`` and ``text``. Pairs carry ``a_id`` from the first
source and ``b_id`` from the second. Nothing here builds the product of the two
sources: requested pairs are scored directly, statistics over all pairs are
taken from sums per document and token, and similar pairs are found through an inverted index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import STOPWORDS
from tallyloom.operators.matching import block_pairs, bounded_pairs
from tallyloom.plans.weights import document_weights, norms, term_frequency, text_parts, unit_weights, weigh
from tallyloom.session import stage_table

# Room for rounding when a bound is compared with the wanted similarity.
_ROUNDING = 1e-9
# The same for the root of a difference of squares.
_ROOT_ROUNDING = 1e-7
#: Tokens whose weights are broadcast: some MB.
_FREQUENT = 100_000


def _side(weights: DataFrame, side: str) -> DataFrame:
    return weights.select(F.col("id").alias(f"{side}_id"), "token", F.col("weight").alias(f"_{side}"))


def only_in_pairs(docs: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """Documents named on one side of the pairs; filtered before any text is split."""
    return docs.join(pairs.select(F.col(f"{side}_id").alias("id")), "id", "left_semi")


def _shared_dots(pairs: DataFrame, a_weights: DataFrame, b_weights: DataFrame) -> DataFrame:
    """Dot product of each pair that shares a token; the pairs must be distinct.

    A document may be in most of the pairs, so its tokens are spread in blocks.
    """
    return (
        block_pairs(pairs, _side(b_weights, "b"), "b_id", "a_id", "token")
        .join(_side(a_weights, "a"), ["a_id", "token"])
        .groupBy("a_id", "b_id")
        .agg(F.sum(F.col("_a") * F.col("_b")).alias("dot"))
    )


def dot_products(pairs: DataFrame, a_weights: DataFrame, b_weights: DataFrame) -> DataFrame:
    """Dot product of each requested pair, 0 without a shared token."""
    shared = _shared_dots(pairs.select("a_id", "b_id").distinct(), a_weights, b_weights)
    return pairs.join(shared, ["a_id", "b_id"], "left").withColumn("dot", F.coalesce("dot", F.lit(0.0)))


def cosines(pairs: DataFrame, a_weights: DataFrame, b_weights: DataFrame) -> DataFrame:
    """Cosine similarity of each requested pair; NULL if one side has no tokens."""
    a_norms = norms(a_weights).select(F.col("id").alias("a_id"), F.col("norm").alias("_a_norm"))
    b_norms = norms(b_weights).select(F.col("id").alias("b_id"), F.col("norm").alias("_b_norm"))
    scored = dot_products(pairs, a_weights, b_weights).join(a_norms, "a_id", "left").join(b_norms, "b_id", "left")
    similarity = F.try_divide(F.try_divide(F.col("dot"), F.col("_a_norm")), F.col("_b_norm"))
    return scored.withColumn("similarity", similarity).select(*pairs.columns, "similarity")


def pair_cosines(
    pairs: DataFrame, a_docs: DataFrame, b_docs: DataFrame, idf: DataFrame, stopwords: Sequence[str] = STOPWORDS
) -> DataFrame:
    """Cosine similarity of requested pairs from the texts of just the documents in them.

    Their weights are needed for the products and for the lengths, so they are staged.
    """
    a_weights = stage_table(document_weights(only_in_pairs(a_docs, pairs, "a"), idf, stopwords, text_parts(a_docs)))
    b_weights = stage_table(document_weights(only_in_pairs(b_docs, pairs, "b"), idf, stopwords, text_parts(b_docs)))
    return cosines(pairs, a_weights, b_weights)


def all_pairs_total(
    a_docs: DataFrame, b_docs: DataFrame, idf: DataFrame, stopwords: Sequence[str] = STOPWORDS, frequent: int = _FREQUENT
) -> DataFrame:
    """One row: number of pairs and sum and mean of all their similarities, zeros included.

    The similarities of a document of the first source with all of the second add up to the product of its unit vector
    and their summed unit vectors. That product and the length of the document's vector are both sums over its tokens,
    so its tokens meet each token's weight and sum once. For the ``frequent`` most common tokens, which most token rows
    have in most texts, these are broadcast; only rows of other tokens are moved. The second source's own
    token rows are moved twice, so it should be the smaller one.
    """
    unit = unit_weights(document_weights(b_docs, idf, stopwords))
    summed = unit.groupBy("token").agg(F.sum("weight").alias("_b"))
    tokens = stage_table(idf.join(summed, "token", "left"))
    common = F.broadcast(tokens.orderBy("idf", "token").limit(frequent))
    # Staged by document, so that sums per document are complete, or nearly, before they are moved.
    frequencies = stage_table(term_frequency(a_docs, stopwords), "zstd")
    weight = F.col("tf") * F.col("idf")

    def document_sums(weighted: DataFrame) -> DataFrame:
        return weighted.groupBy("id").agg(F.sum(weight * weight).alias("_square"), F.sum(weight * F.col("_b")).alias("_dot"))

    others = frequencies.join(common.select("token"), "token", "left_anti").join(tokens, "token")
    sums = document_sums(frequencies.join(common, "token")).unionByName(document_sums(others))
    documents = sums.groupBy("id").agg(F.sum("_square").alias("_square"), F.sum("_dot").alias("_dot"))
    pairs = a_docs.agg(F.count("*")).scalar() * b_docs.agg(F.count("*")).scalar()
    return (
        documents.agg(F.coalesce(F.sum(F.try_divide(F.col("_dot"), F.sqrt("_square"))), F.lit(0.0)).alias("similarity_sum"))
        .select(pairs.alias("pairs"), "similarity_sum")
        .withColumn("similarity_mean", F.try_divide(F.col("similarity_sum"), F.col("pairs")))
    )


def evaluate(
    a_docs: DataFrame,
    b_docs: DataFrame,
    gold: DataFrame,
    idf: DataFrame,
    stopwords: Sequence[str] = STOPWORDS,
) -> DataFrame:
    """One row: true duplicates, their mean similarity, and that of all other pairs.

    The other pairs are never built: their sum is the total over all pairs less
    the duplicates' part, and pairs without a common token count with 0.
    """
    known = gold.join(a_docs.select(F.col("id").alias("a_id")), "a_id", "left_semi").join(
        b_docs.select(F.col("id").alias("b_id")), "b_id", "left_semi"
    )
    duplicates = pair_cosines(known, a_docs, b_docs, idf, stopwords).agg(
        F.count("*").alias("duplicates"), F.coalesce(F.sum("similarity"), F.lit(0.0)).alias("_duplicate_sum")
    )
    # One struct, so that the totals are computed once.
    total = all_pairs_total(a_docs, b_docs, idf, stopwords).select(F.struct("similarity_sum", "pairs"))
    rest_sum = F.col("_total.similarity_sum") - F.col("_duplicate_sum")
    rest_pairs = F.col("_total.pairs") - F.col("duplicates")
    return duplicates.withColumn("_total", total.scalar()).select(
        "duplicates",
        F.try_divide(F.col("_duplicate_sum"), F.col("duplicates")).alias("mean_duplicates"),
        F.try_divide(rest_sum, rest_pairs).alias("mean_others"),
    )


def inverted_index(
    sources: dict[str, DataFrame], idf: DataFrame, stopwords: Sequence[str] = STOPWORDS
) -> DataFrame:
    """Token, source, document and weight: one row per entry of each token's list."""
    parts = [
        document_weights(docs, idf, stopwords).select("token", F.lit(name).alias("source"), "id", "weight")
        for name, docs in sources.items()
    ]
    index = parts[0]
    for part in parts[1:]:
        index = index.unionByName(part)
    return index


_TEXT_KEY = ("_hash", "_other", "_length")


def _with_text_key(docs: DataFrame) -> DataFrame:
    """Two hashes and the length stand for a text where documents are grouped by it; a null text has a key of its own."""
    text = F.col("text")
    return docs.select(
        "id", F.xxhash64(text).alias("_hash"), F.xxhash64(F.lit("text"), text).alias("_other"),
        F.coalesce(F.length(text), F.lit(-1)).alias("_length"), F.coalesce(F.regexp_extract("id", r"([0-9]+)$", 1).try_cast("long"), F.xxhash64("id")).alias("_number"),
    )


def representatives(docs: DataFrame) -> DataFrame:
    """``id``, ``first_id``, ``copies``: every document, and of its copies the one with the smallest number.

    Ids end in a number that tells documents apart. Texts themselves are not
    moved, only their hashes; a text with very many copies is counted before the
    shuffle, and the join back is by hash, where skewed groups are split.
    """
    keyed = stage_table(_with_text_key(docs))
    first = keyed.groupBy(*_TEXT_KEY).agg(F.min("_number").alias("_number"), F.count("*").alias("copies"))
    names = first.join(keyed.select(*_TEXT_KEY, "_number", F.col("id").alias("first_id")), [*_TEXT_KEY, "_number"])
    return keyed.select("id", *_TEXT_KEY).join(names.drop("_number"), list(_TEXT_KEY)).select("id", "first_id", "copies")


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per text with the id of its representative and the number of copies."""
    first = representatives(docs).filter("id = first_id").select("id", "copies")
    return docs.join(first, "id").select("id", "copies", "text")


def _indexed(weights: DataFrame, others: DataFrame, least: float) -> DataFrame:
    """Postings of one side: unit weights of the tokens that the other side has too, each with its ``reach``.

    A document's tokens are taken from the most common to the rarest, in the same order for all documents. The reach of
    a token is the length of the vector of all tokens up to it that the other side has; only these can add to a
    similarity. If a token is the rarest one that two documents share, their similarity is at most the product of its reaches
    in both. Weights are unit weights by the length of the whole vector. Documents whose shared tokens together
    don't reach ``least`` are left out before anything is sorted.
    """
    known = others.select("token", F.lit(True).alias("_shared")).distinct()
    marked = weights.join(known, "token", "left")
    square = F.col("weight") * F.col("weight")
    lengths = marked.groupBy("id").agg(F.sum(square).alias("_whole"), F.sum(F.when(F.col("_shared"), square)).alias("_part"))
    far = lengths.filter(F.col("_part") >= F.col("_whole") * (least * least)).select("id", F.sqrt("_whole").alias("_length"))
    unit = marked.filter("_shared").join(far, "id").select("id", "token", "idf", (F.col("weight") / F.col("_length")).alias("weight"))
    from_common = Window.partitionBy("id").orderBy("idf", "token")
    upto = from_common.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return unit.select("id", "token", "weight", F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(upto)).alias("reach"))


def _postings(index: DataFrame, side: str, least: float) -> DataFrame:
    far = index.filter(F.col("reach") >= least)
    return far.select("token", F.col("id").alias(f"{side}_id"), F.col("weight").alias(f"_{side}_weight"), F.col("reach").alias(f"_{side}_reach"))


def _before(side: str) -> Column:
    """The square of the reach of all tokens before this one."""
    reach, weight = F.col(f"_{side}_reach"), F.col(f"_{side}_weight")
    return F.greatest(reach * reach - weight * weight, F.lit(0.0))


def candidate_pairs(a_index: DataFrame, b_index: DataFrame, least: float) -> DataFrame:
    """``a_id``, ``b_id`` of all pairs that may be as similar as ``least``.

    Ranges of a token's postings whose largest reaches don't multiply to ``least`` never meet. For the postings that do,
    the token's own share of the similarity is known and only the rest is bounded by the reaches.
    """
    sharing = bounded_pairs(_postings(a_index, "a", least), _postings(b_index, "b", least), "token", "a_id", "b_id", "_a_reach", "_b_reach", least)
    most = F.col("_a_weight") * F.col("_b_weight") + F.sqrt(_before("a") * _before("b"))
    return sharing.filter(most >= least - _ROOT_ROUNDING).select("a_id", "b_id").distinct()


def similarity_index(
    a_docs: DataFrame, b_docs: DataFrame, idf: DataFrame | None, least: float, stopwords: Sequence[str] = STOPWORDS
) -> tuple[DataFrame, DataFrame]:
    """Both sides' postings of the distinct texts, for :func:`candidate_pairs`; an id is a struct of the id and its copies. Staged.

    Texts are split once. Without ``idf`` the two sources are the corpus, and a text counts for all its copies.
    """
    sides = (a_docs, b_docs)
    named = [distinct_texts(docs).select(F.struct("id", "copies").alias("id"), "text") for docs in sides]
    frequencies = [stage_table(term_frequency(docs, stopwords, text_parts(whole))) for docs, whole in zip(named, sides)]
    if idf is None:
        documents = a_docs.select("id").unionByName(b_docs.select("id")).agg(F.count_distinct("id")).scalar()
        holders = frequencies[0].unionByName(frequencies[1]).groupBy("token").agg(F.sum("id.copies").alias("n"))
        idf = stage_table(holders.select("token", (documents / F.col("n")).alias("idf")))
    a_weights, b_weights = (weigh(tf, idf) for tf in frequencies)
    return stage_table(_indexed(a_weights, frequencies[1], least)), stage_table(_indexed(b_weights, frequencies[0], least))


def similar_pairs(
    a_docs: DataFrame,
    b_docs: DataFrame,
    idf: DataFrame | None = None,
    min_similarity: float = 0.1,
    stopwords: Sequence[str] = STOPWORDS,
) -> DataFrame:
    """All pairs with at least the given cosine similarity, which must be positive.

    Exact copies are compared once: a row stands for ``a_copies * b_copies``
    pairs and names the representatives; :func:`representatives` lists the copies
    of each. Weights are computed once per text and staged, and so are the candidates. Candidates are pairs with a common token of sufficient reach on both
    sides, which every similar pair has; tokens found in most documents rarely
    reach far enough to be looked up. Each candidate is scored with all tokens.
    Without ``idf`` the two sources are the corpus.
    """
    if min_similarity <= 0:
        raise ValueError("min_similarity must be positive")
    least = min_similarity - _ROUNDING
    a_index, b_index = similarity_index(a_docs, b_docs, idf, least, stopwords)
    candidates = stage_table(candidate_pairs(a_index, b_index, least))
    return (
        _shared_dots(candidates, a_index, b_index)
        .filter(F.col("dot") >= min_similarity)
        .select(
            F.col("a_id.id").alias("a_id"),
            F.col("b_id.id").alias("b_id"),
            F.col("dot").alias("similarity"),
            F.col("a_id.copies").alias("a_copies"),
            F.col("b_id.copies").alias("b_copies"),
        )
    )


def other_pairs(similar: DataFrame, gold: DataFrame, a_docs: DataFrame, b_docs: DataFrame) -> DataFrame:
    """What is left of ``similar_pairs`` without the gold pairs: representatives, similarity and ``pairs``.

    Gold pairs may name any copies. Each is counted for the representatives of its
    two documents, and only so many of the pairs that a row stands for are taken away.
    """
    a_first = representatives(a_docs).select(F.col("id").alias("a_id"), F.col("first_id").alias("_a"))
    b_first = representatives(b_docs).select(F.col("id").alias("b_id"), F.col("first_id").alias("_b"))
    known = gold.select("a_id", "b_id").distinct().join(a_first, "a_id").join(b_first, "b_id")
    counted = known.groupBy(F.col("_a").alias("a_id"), F.col("_b").alias("b_id")).agg(F.count("*").alias("_gold"))
    rest = F.col("a_copies") * F.col("b_copies") - F.coalesce("_gold", F.lit(0))
    return similar.join(counted, ["a_id", "b_id"], "left").withColumn("pairs", rest).filter("pairs > 0").select("a_id", "b_id", "similarity", "pairs")

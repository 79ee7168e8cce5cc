"""The registered queries against their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import compare  # noqa: E402

import corpus_pipeline  # noqa: E402
from tallyloom.llm import bpe, fm_index, ngram_join, quality, queries, superkmers  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare.difference(queries.QUERIES[name](spark, SF_DIR), queries.SQL[name], compare.database(SF_DIR)) is None


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark):
    """Each stage does on its own input what its operator says."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("labels", "benchmark"))
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(corpus_pipeline.staged(stage(spark, seen[-1], SF_DIR)))
        if name != "byte-level BPE":
            assert seen[-1].schema == docs.schema
    start, good, single, unique, clean, tokens = seen
    judged = quality.judge(start, labels).filter("kept").select("doc_id")
    assert sorted(judged.collect()) == sorted(good.select("doc_id").collect())
    first = ngram_join.near_duplicates(good).filter("doc_id = component_id").select("doc_id")
    assert sorted(first.collect()) == sorted(single.select("doc_id").collect())
    assert superkmers.without_repeats(single).agg({"n_removed": "sum"}).first()[0] > 0
    assert sorted(unique.select("doc_id").collect()) == sorted(clean.select("doc_id").collect()) == sorted(first.collect())
    assert fm_index.contamination(unique, benchmark).filter("contaminated").count() > 0
    assert fm_index.contamination(clean, benchmark).filter("contaminated").count() == 0
    with open(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        pairs = bpe.BytePairs(bpe.read_ranks(file.read()))
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert {r.doc_id: b"".join(pairs.strings[int(t)] for t in r.tokens.split()).decode() for r in tokens.collect()} == texts

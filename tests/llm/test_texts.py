"""Operators on one document or page at a time: languages, scores, tokens, quality, main texts, URL verdicts."""

import math
import random
from collections import Counter

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe, html_mincut, langid, ppm, quality, redirects
from tallyloom.llm import common as C

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# Languages


def languages(spark, n=400):
    rng = random.Random(4)
    letters = {"aa": "abcdefg", "bb": "fghijkl", "cc": "klmnopé"}
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(letters))
        rows.append((i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 40))), lang))
    rows += [(n, None, "aa"), (n + 1, "", "aa"), (n + 2, "123 ... \n", "bb"), (n + 3, "é", "cc"), (None, "abc abc", "aa"), (5, rows[5][1], rows[5][2]), (n + 4, "fghij " * 300_000, "bb")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_languages(spark):
    rows, docs = languages(spark)
    got = langid.identify(docs.withColumn("label", F.lit("x"))).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r for r in rows}
    for r in got:
        text = truth[r.doc_id][1]
        assert r.held_out == (cases.fold(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not text or not any(c.isalpha() for c in text))
    right = [r.lang_pred == truth[r.doc_id][2] for r in got if r.held_out and r.lang_pred != "und"]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_labels_of_held_out_rows_are_never_read(spark):
    rows, docs = languages(spark, 120)
    spoiled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "zz").otherwise(F.col("lang")))
    assert Counter(map(tuple, langid.identify(docs).collect())) == Counter(map(tuple, langid.identify(spoiled).collect()))


def test_kernel_is_the_share_of_common_grams():
    number = np.full(1 << langid.HASH_BITS, -1, np.int16)
    texts = ["abcab", "bca", "xyz", "ab" * 10]
    grams = [{t[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)} for t in texts]
    hashes = sorted({h for _, found in langid.gram_hashes(texts) for h in found.tolist()})
    number[hashes] = np.arange(len(hashes))
    rows = langid.kernel_rows(texts, number)
    expected = [[len(a & b) / math.sqrt(len(a) * len(b)) for b in grams] for a in grams]
    assert np.allclose(rows @ rows.T, expected, atol=1e-6)


def test_languages_of_five_texts_in_their_own_scripts(spark):
    rng = random.Random(7)
    letters = {"a": "abcdefghijklmnopqrstuvwxyzéèüö", "b": "αβγδεζηθικλμνξοπρστυφχψω", "ka": "აბგდევზთიკლმნოპჟრსტ", "hy": "աբգդեզէըթժիլխծկհձղճմ"}
    # Of the large languages far more than 8,192 n-grams are in more than five texts.
    words = {lang: ["".join(rng.choice(own) for _ in range(rng.randint(5, 9))) for _ in range(1500)] for lang, own in letters.items()}

    def text(lang):
        return " ".join(rng.choice(words[lang]) for _ in range(100 if lang in "ab" else 3))

    free = [i for i in range(900) if cases.fold(i, 4) != 2]
    truth = {i: "ab"[i % 2] for i in free[:600]} | {i: "ka" for i in free[600:605]} | {i: "hy" for i in free[605:610]}
    asked = {i: ("ka", "hy")[i % 2] for i in range(900, 1200) if cases.fold(i, 4) == 2}
    rows = [(i, text(lang), lang) for i, lang in truth.items()] + [(i, text(lang), None) for i, lang in asked.items()]
    got = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got == truth | asked


def test_scores_are_kernels_with_all_grams():
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdef é") for _ in range(rng.randint(5, 90))) for _ in range(60)]
    labels = [rng.choice("xyz") for _ in texts]
    present = [langid.grams_of(t) for t in texts]
    used = np.unique(np.concatenate(present))
    number = np.full(1 << langid.HASH_BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    rows = langid.kernel_rows(texts, number)
    assert np.allclose(langid.kernels(present, present[:9], number), rows @ rows[:9].T, atol=1e-6)
    model = langid.fit(labels, present)
    weighed = np.zeros((len(used), 3))
    held = np.flatnonzero(model.number >= 0)
    weighed[number[held]] = model.weights[model.number[held]]
    assert np.allclose(model.score(texts), rows @ weighed + model.offset, atol=1e-5)


def test_long_texts_in_pieces_equal_whole_ones(monkeypatch):
    number = np.arange(1 << langid.HASH_BITS, dtype=np.int32) % 5000
    texts = ["abc déf" * 50, "x", "", "zyxw" * 33]
    whole = langid.kernel_rows(texts, number)
    monkeypatch.setattr(langid, "_CHARS", 16)
    assert np.array_equal(whole, langid.kernel_rows(texts, number))


def test_languages_of_nothing(spark, docs, nothing):
    assert langid.identify(nothing).count() == 0
    unlabelled = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}


# Language models


class PlainModel:
    """Prediction by partial matching, byte by byte from dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {}
        for raw in texts:
            for i, byte in enumerate(raw):
                for k in range(order + 1):
                    seen = self.counts.setdefault(self.context(raw, i, k), {})
                    seen[byte] = seen.get(byte, 0) + 1

    @staticmethod
    def context(raw, i, k):
        return (b"\xff" * k + raw[:i])[len(raw[:i]) :] if k else b""

    def probability(self, raw, i):
        excluded, p = set(), 1.0
        for k in range(self.order, -1, -1):
            seen = self.counts.get(self.context(raw, i, k))
            if not seen:
                continue
            open_ = {b: n for b, n in seen.items() if b not in excluded}
            total = sum(open_.values()) + len(open_)
            if raw[i] in open_:
                return p * open_[raw[i]] / total
            if open_:
                p *= len(open_) / total
            excluded |= set(seen)
        return p / (256 - len(excluded))


def test_scores_equal_a_plain_model(docs, rows):
    texts = [(r[1] or "").encode() + b"\xff" for r in rows]
    training = [t for r, t in zip(rows, texts, strict=True) if cases.fold(r[0], 5) != 1]
    model = PlainModel(training, ppm.ORDER)
    tokens = [[*cases.words(cases.lower(r[1] or "")), None] for r in rows]
    count = Counter(w for r, t in zip(rows, tokens, strict=True) if cases.fold(r[0], 5) != 1 for w in t)
    n, v = sum(count.values()), len(count)
    got = {}
    for r in ppm.score_texts(docs).collect():
        got.setdefault((r.doc_id, round(r.score, 4)), []).append(r)
    for r, raw, own in zip(rows, texts, tokens, strict=True):
        if len(raw) > 4000:
            continue
        score = sum(math.log10(model.probability(raw, i)) for i in range(len(raw)))
        found = got[r[0], round(score, 4)][0]
        assert (found.held_out, found.n_tokens, found.n_known, found.train_tokens) == (cases.fold(r[0], 5) == 1, len(own), sum(count[w] > 0 for w in own), n)
        assert math.isclose(found.base_score, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    raw = np.concatenate([rng.integers(97, 105, 4000), [255]]).astype(np.uint8)
    keys, counts = np.unique(ppm.nodes_of(raw), return_counts=True)
    trie = ppm.Trie(keys, counts)
    for context in [*(keys[::97] >> np.uint64(8)).tolist(), 0x61000000, 0x00000061, 0x61616100, (1 << 8 * ppm.ORDER) - 1]:
        assert math.isclose((10 ** trie.score((np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64))).sum(), 1, rel_tol=1e-9)


def test_a_bounded_trie_keeps_the_most_frequent(spark, docs, monkeypatch):
    monkeypatch.setattr(ppm, "MAX_NODES", 500)
    shards = C.shards_of(docs)
    trie = ppm.train(shards, 5, 1, 4)
    assert 0 < len(trie.levels[0]["key"]) <= 500


def test_every_node_counts_however_many_there_are(docs, rows, monkeypatch):
    monkeypatch.setattr(ppm, "MAX_NODES", 500)
    monkeypatch.setattr(ppm, "_PART_BYTES", 1 << 12, raising=False)
    raw = [np.frombuffer((r[1] or "").encode() + b"\xff", np.uint8) for r in rows]
    nodes = [ppm.nodes_of(t) for t in raw]
    trie = ppm.Trie(*np.unique(np.concatenate([n for r, n in zip(rows, nodes, strict=True) if cases.fold(r[0], 5) != 1]), return_counts=True))
    assert len(trie.levels[0]["key"]) > 500
    expected = Counter((r[0], round(trie.score(n).sum(), 5)) for r, n in zip(rows, nodes, strict=True))
    assert Counter((r.doc_id, round(r.score, 5)) for r in ppm.score_texts(docs).collect()) == expected


def test_scores_of_nothing(nothing):
    assert ppm.score_texts(nothing).count() == 0


# Tokens


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as file:
        ranks = bpe.read_ranks(file.read())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_equal_the_library(docs, rows, encoding):
    expected = Counter()
    for r in rows:
        ids = encoding[1].encode_ordinary(r[1] or "")
        expected[r[0], len(ids), cases.sha(" ".join(map(str, ids))), cases.sha(r[1] or "")] += 1
    assert Counter(tuple(r) for r in bpe.round_trips(docs, RANKS, public_tokenizers.PATTERN).collect()) == expected


def test_merges_alone_and_together(encoding):
    ranks, library = encoding
    rng = random.Random(1)
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))) for alphabet in ("ab", "eth", "ethaonrs", "éè日🙂", "  a") for _ in range(60)] + ["a" * 5000, "<|endoftext|>"]
    pairs = bpe.BytePairs(ranks)
    expected = [library.encode_ordinary(p) for p in pieces]
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    assert [x.tolist() for x in tokenizer.encode_texts(pieces)] == expected
    single = [p for p in pieces if len(tokenizer.split(p)) == 1]
    assert [pairs.encode(p.encode()) for p in single] == [library.encode_ordinary(p) for p in single]
    assert all(pairs.decode(np.array(x)) == p.encode() for x, p in zip(expected, pieces, strict=True))


def test_a_full_memory_changes_nothing(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 10)
    tokenizer = bpe.Tokenizer(encoding[0], public_tokenizers.PATTERN)
    for text in ["the cat sat on the mat", "an other text with more words in it", "the end"] * 3:
        assert next(tokenizer.encode_texts([text])).tolist() == encoding[1].encode_ordinary(text)


def test_tokens_of_nothing(nothing):
    assert bpe.round_trips(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


# Quality


def plain_counts(text):
    text = text or ""
    words, seen, lines = cases.words(text), {}, Counter()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines.update(line for line in text.split("\n") if cases.words(line))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(n - 1 for n in lines.values()), len(repeated), failed


def test_counts_equal_plain_counts(spark, docs, rows):
    labels = spark.createDataFrame([], "doc_id long, quality long")
    more = spark.createDataFrame([(900, "é# **\n \né# **\n\né# **"), (901, "a b c d e a b c d e f\r\na b"), (902, "\n\n"), (903, "x|<y>&日本 日本")], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    expected = Counter()
    for doc_id, text in [(r[0], r[1]) for r in rows] + [tuple(r) for r in more.collect()]:
        counts = plain_counts(text)
        expected[(doc_id, *counts, not counts[-1], 1.0)] += 1
    assert Counter(tuple(r) for r in quality.judge(every, labels).collect()) == expected


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(3)
    rows = rng.random((4000, 4))
    good = (rows[:, 0] + 0.3 * np.sin(9 * rows[:, 1]) + 0.1 * rng.standard_normal(4000) < 0.6).astype(float)
    trees = quality.fit(rows, good, np.array([-1, 0, 1, 0]), rounds=25)
    fresh = rng.random((2000, 4))
    truth = fresh[:, 0] + 0.3 * np.sin(9 * fresh[:, 1]) < 0.6
    assert np.mean((trees.probability(fresh) > 0.5) == truth) > 0.9
    for column, sign in ((0, -1), (2, 1)):
        higher = fresh.copy()
        higher[:, column] += 0.3
        assert (sign * (trees.probability(higher) - trees.probability(fresh)) >= -1e-12).all()


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    known = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 0)
    got = quality.judge(docs, known).join(labels.join(known, "doc_id", "left_anti"), "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.98
    assert np.mean([r.kept for r in got if r.quality == 0]) < 0.3


def test_quality_of_nothing(spark, nothing, docs):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality long")
    assert quality.judge(nothing, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == quality.judge(docs, labels).filter("kept").count()


# Pages

PAGE = """<html><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a><li><a href="/b">More &amp; more</a></ul></nav>
<div class="cookie-notice">We use cookies on this page, as you may know.</div>
<article><header><h1>A &lt;title&gt;</h1></header><p>First&nbsp;paragraph<br>of  <b>text</b>.<p>Second one, unclosed
<script>var a = "<p>no</p>";</script><ul><li>Item</li></ul><div class="ad">Buy this now, it is very cheap.</div>
<p><a href=z>A linked paragraph</a></p><article class="comment"><p>Another reader says something of some length.</p></article>
<form>Your name <input name=q></form><section id="comments"><p>A reader says this is a long and good text.</p></section></article>
<aside>Related things to read</aside><footer>&copy; 2020</footer></body></html>"""


def test_article_of_a_page():
    assert html_mincut.main_text(PAGE) == "A <title>\n\nFirst paragraph of text.\n\nSecond one, unclosed\n\nItem\n\nA linked paragraph"


@pytest.mark.parametrize("html", [None, "", "<p", "<<<>>>", "</div></p>", "<script>x", "<!-- a", "<body><nav>a</nav>", "<title>t", "&#xD800;<p>&#0;"])
def test_broken_pages(html):
    assert isinstance(html_mincut.main_text(html), str)


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>T</title><p>{0}", "<html><head><meta a=b>{0}", "<body><noscript>x<p>{0}", "<body><div><noscript>x</div><p>{0}</p><noscript>y</noscript>",
        "<body><div><select><option>x</div><p>{0}</p>", "<body><select><option>x<p>{0}</p>", "<body><div><button>x</div><p>{0}</p><button>y</button>",
        "<body><svg><text>x<p>{0}</p>", "<body><div><object>x</div><p>{0}</p>", "<body><noscript><div>x</div></noscript><p>{0}",
    ],
)
def test_pages_with_unclosed_hidden_elements_keep_their_text(html):
    long = "This is a paragraph of the text that goes on for quite a while, with several words. " * 3
    assert long.strip() in html_mincut.main_text(html.format(long))


def test_deeply_nested_pages():
    long = "This is a paragraph of the text that goes on for quite a while, with several words."
    assert html_mincut.main_text("<body>" + "<div>" * 5000 + f"<p>{long}") == long
    assert html_mincut.main_text("<body>" + f"<div><p>{long}</p>" * 5000).count(long) == 5000


def test_formulas_of_an_article_stay():
    long = "This is a paragraph that goes on for quite a while, with several words."
    assert html_mincut.main_text(f"<article><p>{long} <math><mi>x</mi><mo>=</mo><mn>7</mn></math> holds.</p></article>") == f"{long} x=7 holds."


def test_a_page_without_article_keeps_its_long_paragraphs():
    long = "This is a paragraph of the text that goes on for quite a while, with several words. " * 2
    page = f"<body><div><a href=x>One</a> <a href=y>Two</a></div><div class=post><p>{long}</p><p>Short.</p><p>{long}</p></div><div class='footer'>{long}</div>"
    assert html_mincut.main_text(page) == "\n\n".join([long.strip(), "Short.", long.strip()])


def test_minimum_cut_is_the_least_cost():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 8)
        terminal = [rng.randint(-20, 20) for _ in range(n)]
        edges = {(i, j): rng.randint(0, 12) for i in range(n) for j in range(i) if rng.random() < 0.6}

        def cost(side):
            return sum(max(t, 0) * (not s) + max(-t, 0) * s for t, s in zip(terminal, side, strict=True)) + sum(c * (side[i] != side[j]) for (i, j), c in edges.items())

        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(html_mincut.minimum_cut(terminal, edges)) == best


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (1, None, PAGE), (None, "u", None), (3, "u", "")]
    pages = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")
    got = html_mincut.extract(pages).collect()
    text = html_mincut.main_text(PAGE)
    assert Counter(map(tuple, got)) == Counter([(1, "u", text, len(text)), (1, None, text, len(text)), (None, "u", "", 0), (3, "u", "", 0)])
    assert html_mincut.extract(pages.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_mincut.extract(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<(b|/b|br)>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(p for p in parts if p)


def test_texts_are_measured_in_slices_of_bytes():
    import pyarrow as pa

    texts = pa.array(["a" * 5, None, "", "b" * 9, "c" * 30, "d", "é" * 4, "e"])
    assert list(quality._slices(texts, 10)) == [(0, 3), (3, 4), (4, 5), (5, 8)]
    assert list(quality._slices(texts, 1000)) == [(0, 8)] and list(quality._slices(texts.slice(0, 0))) == []


# URLs

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("same.org/x", "block"), ("same.org/x", "allow")]


def verdicts(spark, rows, redirect_rows=None):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    more = spark.createDataFrame(redirect_rows, "url string, to string") if redirect_rows else None
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in redirects.filter_urls(pages, redirects.rules_table(spark, RULES), more).collect()}


def test_rules(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.NET/en/1?x#y", "http://example.net/de/", "http://net/", "http://net", "http://planet/",
        "https://www.example.com/de/1", "https://example.com/DE/", "http://a.org/fr/?q", "ftp://same.org/xy", "x://É.net/#", "a://b://c/",
    ]
    got = verdicts(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [got[i] for i in range(len(urls))] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/de/", "net/", "block"), ("net", "/", "net/", "block"), ("net", "", None, "allow"), ("planet", "/", None, "allow"),
        ("www.example.com", "/de/1", "example.com/de/", "block"), ("example.com", "/DE/", None, "allow"), ("a.org", "/fr/", "org/fr/", "allow"),
        ("same.org", "/xy", "same.org/x", "allow"), ("É.net", "/", "net/", "block"), ("b:", "//c/", None, "allow"),
    ]


def test_blocks_reach_aliases(spark):
    canonical = '<link href="{0}" REL=canonical>'
    rows = [
        (1, "http://a.com/1", canonical.format("http://b.com/2")), (2, "http://b.com/2#f", '<meta http-equiv="refresh" content="0; url=/3">'),
        (3, "https://b.com/3", ""), (4, "http://c.com/", None), (5, "http://bad.net/x", canonical.format("//b.com/3")),
        (6, "http://example.net/en/9", canonical.format("http://bad.net/x")), (7, "http://d.com/q?a=1", canonical.format("e")), (8, "http://d.com/e", ""),
        (8, "http://d.com/e", ""), (9, "http://f.com", canonical.format("")),
    ]
    got = verdicts(spark, rows, [("http://c.com", "http://g.com/"), ("http://g.com/", "http://h.net/"), (None, "http://h.net/")])
    assert {i: v[3] for i, v in got.items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow", 9: "allow"}


def test_every_link_of_a_page_counts(spark):
    """Also the second canonical link, the second redirect and a repeated one; all code compiles."""
    links = '<link rel=canonical href="http://x.com/1"><link rel="canonical" href=http://x.com/1><link rel=canonical href="http://bad.net/9">'
    turns = '<meta http-equiv=refresh content="1; url=http://y.com/"><META content="0;URL=/moved" HTTP-EQUIV="refresh">'
    rows = [(1, "http://p.com/a", links), (2, "http://x.com/1", ""), (3, "http://q.com/b", turns), (4, "http://q.com/moved", '<link rel=canonical href="http://bad.net/7">'), (5, "http://y.com/", "")]
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        got = verdicts(spark, rows)
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
    assert {i: v[3] for i, v in got.items()} == dict.fromkeys(range(1, 6), "block")


def test_urls_of_nothing(spark):
    assert verdicts(spark, []) == {}


def test_no_python_runs_for_urls(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "")], "page_id long, url string, html string")
    plan = redirects.filter_urls(pages, spark.createDataFrame([("net/", "block")], "rule string, action string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan

"""Alignment of tokenizers against whole texts encoded at once and compared token by token."""

import random
from collections import Counter, defaultdict

import cases
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import queries
from tallyloom.llm import token_alignment as T

SF_DIR = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def byte_of_letter():
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def plain():
    """Rows of the operator from whole texts."""
    first, second, letters = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), byte_of_letter()
    first.encode_special_tokens = True

    def second_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def run(rows):
        linked, found = [], []
        for doc_id, text in rows:
            groups, links = [], []
            a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
            b = second.encode(text) if text else []
            sides = [[bytes(letters[c] for c in first.id_to_token(i)) for i in a], [second_bytes(i) for i in b]]
            if not text or any(b"".join(s) != (" " + text).encode() for s in sides):
                a = b = []
            ends = [[sum(map(len, s[: k + 1])) for k in range(len(s))] for s in sides] if len(a) < 3000 else [running(s) for s in sides]
            both = set(ends[0]) & set(ends[1]) if a else set()
            i = j = 0
            for end in sorted(both):
                x, y = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                links.append((a[x - 1], b[y - 1]))
                i, j = x, y
            found.append((doc_id, len(a), len(b), groups, links))
            linked += links
        count = Counter(linked)
        top = defaultdict(int)
        for (_, y), n in count.items():
            top[y] = max(top[y], n)
        return sorted(((i, n, m, len(g), len(k), sum(count[p] == top[p[1]] for p in k), sum(count[p] for p in k), cases.sha(";".join(g)) if g else "") for i, n, m, g, k in found), key=str)

    return run


def running(parts):
    total, out = 0, []
    for part in parts:
        total += len(part)
        out.append(total)
    return out


def got(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


AWKWARD = ["<|endoftext|> and <s> </s> <unk>", "two  spaces", " leading", "trailing ", "tab\tand\nline", "▁ mark", "a b", "ﬁne ligature", "don't we'll I'm", "日本語 text 中文", "😀 a 😀😀 b", "x" * 4000, "é é ñ ż ſ ŉ", "1,234.56 (a) - b", " ", "　", "a ́b", "\x00 zero \x7f", "a ' s 's", "ĿL ŀl ĳ"]


def test_documents_with_every_case(spark, docs, rows, plain):
    rows = [r[:2] for r in rows] + [(1000 + i, t) for i, t in enumerate(AWKWARD)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows[-len(AWKWARD) :], "doc_id long, text string"))
    want = plain(rows)
    assert got(T.align(df, *PATHS)) == want
    # All texts of more than some bytes cut into pieces, and these into ranges that end inside groups.
    assert got(T.align(df, *PATHS, long=200, width=7)) == want


def test_query_equals_whole_texts(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got(queries.QUERIES["op13_token_alignment"](spark, SF_DIR)) == plain(rows)


def test_empty_table(nothing):
    assert T.align(nothing, *PATHS).count() == 0


def test_fragments_compose_in_any_order():
    """Cut anywhere, composed in any tree: the fragment of the whole."""
    rng = random.Random(3)
    for _ in range(300):
        total = rng.randint(1, 40)
        a_end, b_end = (sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total // 2))}) for _ in range(2))
        a, b = [rng.randrange(9) for _ in a_end], [rng.randrange(9) for _ in b_end]
        whole = T.fragment(a, b, a_end, b_end)
        cuts = [0, *sorted(rng.choices(range(total + 1), k=rng.randint(0, 5))), total]
        parts = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            sides = [[(i, e) for i, e in zip(ids, ends) if low < e <= high] for ids, ends in ((a, a_end), (b, b_end))]
            parts.append(T.fragment(*[[i for i, _ in s] for s in sides], *[[e for _, e in s] for s in sides]))
        assert T.composed(parts) == whole
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert parts[0] == whole == T.EMPTY + whole == whole + T.EMPTY

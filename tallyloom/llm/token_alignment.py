"""Alignment of two tokenizers: byte offsets where tokens of both end cut a text into groups.

A *fragment* describes a range of bytes of a document: the tokens before its first common end (open prefix), the closed
groups, and the tokens after its last common end (open suffix). Fragments compose: the open ends that meet become one
group, closed if a common end follows. Composition is associative and the fragment without bytes is neutral, so
the fragments of a document may be made anywhere and composed in any tree.

Texts are encoded in *units*. A space between two visible ASCII or Latin characters always begins a token of both
tokenizers and nothing merges across it, so the text from one such space to the next is encoded once per task however
often it is met, and gives a fragment that is closed on both sides. A text of more than ``LONG`` bytes is
cut into pieces that are encoded in different tasks. Each piece is cut again into ranges of ``RANGE`` bytes wherever
they fall, inside groups too; their fragments are composed 16 at a time, across tasks, until each document has one.

Documents travel in blocks of some megabytes of text. A block sends each pair of ids that it links once, with its
count; the sums over the corpus, and whether they are the highest for their second id, come back to the block.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common as C

#: Bytes of text beyond which a document is cut into pieces, and about the bytes of a piece.
LONG = 1 << 20
#: Bytes of one range of a long document.
RANGE = 1 << 16
#: Bytes of text of a block, and of the texts that are encoded together.
BLOCK_BYTES, STEP_BYTES = 4 << 20, 1 << 18
#: Bytes, about, of the units that a task remembers.
REMEMBERED = 192 << 20
FAN = 16

#: Visible ASCII, and Latin letters that no normalisation changes.
_VISIBLE = "!-~À-ÖØ-öø-ıĴ-ľŁ-ňŊ-ž"
# Fixed value: how a byte-level tokenizer cuts a text before merging.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile(f"(?<=[{_VISIBLE}]) (?=[{_VISIBLE}])")


# Tokenizers ---------------------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the rest from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Two tokenizers, and the bytes of each of their ids: byte-level BPE of space and text, pieces of the text."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first, self.second = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
        self.first.encode_special_tokens = True
        letters = _byte_letters()
        self.ranked = _by_rank(first, letters)
        names = self.first.get_vocab()
        self.first_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.first_bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.first_sizes, self.second_sizes = [len(x) for x in self.first_bytes], [len(x) for x in self.second_bytes]
        #: Whether a piece goes on after a space inside it; then units of the text can't be encoded one by one.
        self.crossing = any(" " in p.lstrip(" ") for p in (x.replace("▁", " ") for x in pieces))

    def units(self, text: str) -> list[str]:
        """The text in parts that are encoded by themselves; between them one space each."""
        return [text] if self.crossing else _CUT.split(text)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int], bool]]:
        """Ids of both for each text, and whether the tokens of both are the bytes of space and text."""
        spaced = [f" {t}" for t in texts]
        if self.ranked:  # its tokens are the bytes of the text, whatever they are
            first, spells = map(self.ranked.encode_ordinary, spaced), True
        else:
            first, spells = [e.ids for e in self.first.encode_batch(spaced, add_special_tokens=False)], False
        for text, a, b in zip(spaced, first, self.second.encode(texts, num_threads=1), strict=True):
            want = text.encode()
            yield a, b, b"".join([self.second_bytes[i] for i in b]) == want and (spells or b"".join([self.first_bytes[i] for i in a]) == want)


def _by_rank(file: str, letters: dict[str, int]):
    """The same encoder over merge ranks, which is several times as fast; None if the file's ids are not in order of its merges."""
    import tiktoken

    with open(file, encoding="utf-8") as opened:
        whole = json.load(opened)
    model, before = whole["model"], whole["pre_tokenizer"] or {}
    if whole["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(left + right) != 256 + i for i, (left, right) in enumerate(pairs)):
        return None
    ranks = {bytes([letters[c] for c in name]): i for name, i in model["vocab"].items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("ranked", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> Tokenizers:
    return Tokenizers(first, second)


# Fragments ----------------------------------------------------------------------------------------------------------


def _group(a: Iterable[int], b: Iterable[int]) -> str:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}"


@dataclass
class Fragment:
    """What is known of a range of bytes; without a ``cut`` all its tokens are in ``prefix``.

    ``prefix`` and ``suffix`` hold ids of both sides. ``closed`` are the groups after the first cut, as text;
    ``links`` the pairs of ids that end together, the first cut's among them.
    """

    prefix: tuple[list[int], list[int]]
    closed: list[str]
    links: list[tuple[int, int]]
    suffix: tuple[list[int], list[int]]
    cut: bool

    def __add__(self, other: Fragment) -> Fragment:
        if not other.cut:
            if not self.cut:
                return Fragment(_both(self.prefix, other.prefix), [], [], ([], []), False)
            return Fragment(self.prefix, self.closed, self.links, _both(self.suffix, other.prefix), True)
        if not self.cut:
            return Fragment(_both(self.prefix, other.prefix), other.closed, other.links, other.suffix, True)
        middle = _group(*_both(self.suffix, other.prefix))
        return Fragment(self.prefix, [*self.closed, middle, *other.closed], self.links + other.links, other.suffix, True)

    def groups(self) -> list[str]:
        """The groups of a whole document: a fragment of its first to its last byte."""
        return [_group(*self.prefix), *self.closed] if self.cut else []


def _both(x, y):
    return x[0] + y[0], x[1] + y[1]


EMPTY = Fragment(([], []), [], [], ([], []), False)


def cut_groups(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The groups of the tokens whose ends are given, as the places after their last tokens, and their links."""
    places, links, x, y = [], [], 0, 0
    while x < len(a_ends) and y < len(b_ends):
        if a_ends[x] == b_ends[y]:
            links.append((a[x], b[y]))
            x, y = x + 1, y + 1
            places.append((x, y))
        elif a_ends[x] < b_ends[y]:
            x += 1
        else:
            y += 1
    return places, links


def fragment(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int]) -> Fragment:
    """The fragment of the tokens whose ends fall in a range of bytes."""
    places, links = cut_groups(a, b, a_ends, b_ends)
    if not places:
        return Fragment((a, b), [], [], ([], []), False)
    closed = [_group(a[i:x], b[j:y]) for (i, j), (x, y) in zip(places[:-1], places[1:], strict=True)]
    (i, j), (x, y) = places[0], places[-1]
    return Fragment((a[:i], b[:j]), closed, links, (a[x:], b[y:]), True)


def composed(fragments: Iterable[Fragment]) -> Fragment:
    """All fragments in order, added up in a balanced tree."""
    level = list(fragments)
    while len(level) > 1:
        level = [level[i] + level[i + 1] if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0] if level else EMPTY


class Units:
    """The units that a task has met: their numbers of tokens, their groups as text and their links."""

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self.forget()

    def forget(self) -> None:
        self.size = 0
        self.place: dict[str, int] = {}
        self.text: list[str] = []
        #: Per unit: tokens of both, groups, whether the bytes are the text's.
        self.facts = np.zeros((0, 4), np.int64)
        #: The links of all units, and where those of each end.
        self.codes, self.ends = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, units: Iterable[str]) -> None:
        new = [u for u in dict.fromkeys(units) if u not in self.place]
        if not new:
            return
        facts, codes, ends, at, tools = [], [], [], len(self.codes), self.tools
        a_size, b_size = tools.first_sizes.__getitem__, tools.second_sizes.__getitem__
        for unit, (a, b, ok) in zip(new, tools.encode(new), strict=True):
            places, links, i, j, text = (), (), 0, 0, []
            if ok:  # then the last tokens of both end together
                places, links = cut_groups(a, b, list(accumulate(map(a_size, a))), list(accumulate(map(b_size, b))))
            for x, y in places:
                text.append(_group(a[i:x], b[j:y]))
                i, j = x, y
            self.place[unit] = len(self.text)
            self.text.append(";".join(text))
            self.size += 400 + 5 * len(unit) + len(self.text[-1])
            facts.append((len(a), len(b), len(links), ok))
            codes += [(x << 32) | y for x, y in links]
            ends.append(at + len(codes))
        self.facts = np.concatenate([self.facts, np.array(facts, np.int64)])
        self.codes, self.ends = np.append(self.codes, np.array(codes, np.int64)), np.append(self.ends, ends)


# Blocks of documents ------------------------------------------------------------------------------------------------

_DOCS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())])
_BLOCKS = "block long, docs binary, codes binary, counts binary, refs binary, n_links binary"


def _block(number: int, ids: list, facts: np.ndarray, digests: list[str], links: np.ndarray) -> dict:
    """One block: rows of documents, the distinct pairs of ids with their counts, and for each link its pair."""
    codes, refs, counts = np.unique(links, return_inverse=True, return_counts=True)
    docs = pa.table([pa.array(ids, pa.int64()), *(pa.array(facts[:, k]) for k in range(4)), pa.array(digests, pa.string())], schema=_DOCS)
    return {
        "block": [number], "docs": [C._row_blob(docs)], "codes": [codes.astype(np.int64).tobytes()], "counts": [counts.astype(np.int64).tobytes()],
        "refs": [refs.ravel().astype(np.uint32 if len(codes) >> 16 else np.uint16).tobytes()], "n_links": [facts[:, 3].astype(np.int64).tobytes()],
    }


def _encode_docs(paths: tuple[str, str]):
    """Blocks of documents that are encoded whole in one task."""
    fields = C.pa_schema(_BLOCKS)

    def run(batches):
        units, task, made = Units(tokenizers(*paths)), TaskContext.get().partitionId(), 0
        ids, facts, digests, links, size = [], [], [], [], 0

        def encoded(keys: list, texts: list[str | None]):
            cut = [units.tools.units(t) if t else [] for t in texts]
            if units.size > REMEMBERED:
                units.forget()
            units.learn(u for us in cut for u in us)
            at = [[units.place[u] for u in us] for us in cut]
            every = np.array([p for ps in at for p in ps], np.int64)
            known, ends = units.facts, units.ends
            stops = np.cumsum([0, *map(len, at)])
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(known[every], axis=0)])[stops]
            sums = sums[1:] - sums[:-1]
            good = sums[:, 3] == np.diff(stops)
            good &= np.diff(stops) > 0
            take = every[np.repeat(good, np.diff(stops))]
            n = ends[take + 1] - ends[take]
            links.append(units.codes[np.repeat(ends[take] - np.cumsum(n) + n, n) + np.arange(n.sum())])
            facts.append(np.where(good[:, None], sums[:, [0, 1, 2, 2]], 0))
            digests.extend(C.sha256(";".join([units.text[p] for p in ps]).encode()) if ok else "" for ps, ok in zip(at, good.tolist(), strict=True))
            ids.extend(keys)

        def flush():
            nonlocal made, size
            row = _block((task << 24) | made, ids, np.concatenate(facts), digests, np.concatenate(links))
            made, size = made + 1, 0
            for held in (ids, facts, digests, links):
                held.clear()
            return C.record_batch(row, fields)

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            start = total = 0
            for i, length in enumerate(lengths):
                total += length
                if total >= STEP_BYTES or i + 1 == len(lengths):
                    part = batch.slice(start, i + 1 - start)
                    encoded(part.column(0).to_pylist(), part.column(1).to_pylist())
                    size, start, total = size + total, i + 1, 0
                    if size >= BLOCK_BYTES:
                        yield flush()
        if ids:
            yield flush()

    return run


# Long documents -----------------------------------------------------------------------------------------------------

_PIECES = "row long, piece long, doc_id long, start long, text string"
_FRAGMENTS = "row long, position long, doc_id long, ok boolean, n_a long, n_b long, cut boolean, prefix_a binary, prefix_b binary, closed string, n_closed long, links binary, suffix_a binary, suffix_b binary"


def _cut_long(paths: tuple[str, str], size: int):
    """Pieces of long texts, each a run of units, with the byte they start at in space and text."""
    fields = C.pa_schema(_PIECES)

    def run(batches):
        tools = tokenizers(*paths)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                start, at, number = 0, 0, 0
                while at < len(text):
                    # A piece ends at the first cut after so many characters; lookbehind needs one more.
                    found = None if tools.crossing else _CUT.search(text, min(at + size, len(text)))
                    end = found.start() if found else len(text)
                    part = text[at:end]
                    yield C.record_batch({"row": [row], "piece": [number], "doc_id": [doc_id], "start": [start], "text": [part]}, fields)
                    start, at, number = start + 1 + len(part.encode()), end + 1, number + 1

    return run


def _ranges(tools: Tokenizers, text: str, start: int, width: int) -> Iterator[tuple[int, bool, int, int, Fragment]]:
    """Per range of bytes that the piece reaches: its number, whether all is well, tokens of both, and the fragment."""
    a, b, a_end, b_end, ok, at = [], [], [], [], True, start
    for unit, (x, y, good) in _with_ids(tools, text):
        ok &= good
        a += x
        b += y
        for ends, table, ids in ((a_end, tools.first_bytes, x), (b_end, tools.second_bytes, y)):
            ends += (at + np.cumsum([len(table[i]) for i in ids])).tolist()
        at += 1 + len(unit.encode())
        upto = (at - 1) // width * width  # ranges up to here are complete
        if a_end and a_end[0] <= upto:
            yield from _split(a, b, a_end, b_end, ok, upto, width)
            a, b = a[_upto(a_end, upto) :], b[_upto(b_end, upto) :]
            a_end, b_end = a_end[_upto(a_end, upto) :], b_end[_upto(b_end, upto) :]
    yield from _split(a, b, a_end, b_end, ok, at + width, width)


def _with_ids(tools: Tokenizers, text: str):
    units = tools.units(text)
    for k in range(0, len(units), 1000):
        step = units[k : k + 1000]
        yield from zip(step, tools.encode(step), strict=True)


def _upto(ends: list[int], place: int) -> int:
    return int(np.searchsorted(ends, place, side="right"))


def _split(a, b, a_end, b_end, ok, upto, width):
    i, j, stop_a, stop_b = 0, 0, _upto(a_end, upto), _upto(b_end, upto)
    while i < stop_a or j < stop_b:
        first = min(a_end[i] if i < stop_a else upto, b_end[j] if j < stop_b else upto)
        number = (first - 1) // width
        x, y = min(stop_a, _upto(a_end, (number + 1) * width)), min(stop_b, _upto(b_end, (number + 1) * width))
        yield number, ok, x - i, y - j, fragment(a[i:x], b[j:y], a_end[i:x], b_end[j:y])
        i, j = x, y


def _fragment_row(row: int, position: int, doc_id, ok: bool, n_a: int, n_b: int, f: Fragment) -> dict:
    links = np.array([(x << 32) | y for x, y in f.links] if isinstance(f.links, list) else f.links, np.int64)
    return {
        "row": [row], "position": [position], "doc_id": pa.array([doc_id], pa.int64()), "ok": [ok], "n_a": [n_a], "n_b": [n_b], "cut": [f.cut],
        "prefix_a": [np.array(f.prefix[0], np.int32).tobytes()], "prefix_b": [np.array(f.prefix[1], np.int32).tobytes()],
        "closed": [";".join(f.closed)], "n_closed": [len(f.closed)], "links": [links.tobytes()],
        "suffix_a": [np.array(f.suffix[0], np.int32).tobytes()], "suffix_b": [np.array(f.suffix[1], np.int32).tobytes()],
    }


def _read_fragment(rows: dict, i: int) -> Fragment:
    ids = {name: np.frombuffer(rows[name][i], np.int32).tolist() for name in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")}
    codes = np.frombuffer(rows["links"][i], np.int64)
    closed = rows["closed"][i].split(";") if rows["n_closed"][i] else []
    return Fragment((ids["prefix_a"], ids["prefix_b"]), closed, list(zip((codes >> 32).tolist(), (codes & 0xFFFFFFFF).tolist(), strict=True)), (ids["suffix_a"], ids["suffix_b"]), rows["cut"][i])


def _encode_pieces(paths: tuple[str, str], width: int):
    fields = C.pa_schema(_FRAGMENTS)

    def run(batches):
        tools = tokenizers(*paths)
        for batch in batches:
            for i in range(batch.num_rows):
                row, piece, doc_id, start, text = (batch.column(k)[i].as_py() for k in range(5))
                for number, ok, n_a, n_b, found in _ranges(tools, text, start, width):
                    yield C.record_batch(_fragment_row(row, (piece << 32) | number, doc_id, ok, n_a, n_b, found), fields)

    return run


def _compose(rows: dict[str, list]) -> Iterator[dict]:
    order = sorted(range(len(rows["position"])), key=rows["position"].__getitem__)
    whole = composed(_read_fragment(rows, i) for i in order)
    yield _fragment_row(rows["row"][0], rows["step"][0], rows["doc_id"][0], all(rows["ok"]), sum(rows["n_a"]), sum(rows["n_b"]), whole)


def _finish_long(rows: dict[str, list]) -> Iterator[dict]:
    for i, ok in enumerate(rows["ok"]):
        whole, links = _read_fragment(rows, i), np.frombuffer(rows["links"][i], np.int64)
        n = len(whole.closed) + 1
        facts = np.array([[rows["n_a"][i], rows["n_b"][i], n, len(links)] if ok else [0] * 4], np.int64)
        digest = C.sha256(";".join(whole.groups()).encode()) if ok else ""
        yield _block(-1 - rows["row"][i], [rows["doc_id"][i]], facts, [digest], links if ok else links[:0])


def _long_blocks(docs: DataFrame, paths: tuple[str, str], long: int, width: int) -> DataFrame:
    """Blocks of one long document each, its fragments composed in a tree of groups."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    pieces = C.staged(numbered.mapInArrow(_cut_long(paths, long), _PIECES))
    spread = max(1, pieces.count())
    fragments = C.staged(pieces.repartition(spread, "row", "piece").mapInArrow(_encode_pieces(paths, width), _FRAGMENTS))
    ranked = fragments.select(F.col("row"), "position").groupBy("row").agg(F.sort_array(F.collect_list("position")).alias("places"))
    places = ranked.select("row", F.posexplode("places").alias("rank", "position"))
    level = fragments.join(places, ["row", "position"]).drop("position").withColumnRenamed("rank", "position")
    depth = (ranked.agg(F.max(F.size("places"))).first()[0] or 1) - 1
    while True:
        grouped = level.withColumn("position", F.col("position").cast("long")).withColumn("step", F.floor(F.col("position") / FAN))
        level = C.map_groups(grouped, ["row", "step"], _compose, _FRAGMENTS)
        depth //= FAN
        if not depth:
            return C.map_groups(level, ["row"], _finish_long, _BLOCKS)


# The operator -------------------------------------------------------------------------------------------------------


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, codes, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            codes = np.frombuffer(codes, np.int64)
            yield pa.record_batch({"block": np.full(len(codes), block), "code": codes, "n": np.frombuffer(counts, np.int64)})


def linked_pairs(blocks: DataFrame) -> DataFrame:
    """``code, n, best``: every pair of ids that the corpus links, how often, and whether that is its second id's highest count.

    A code is the first id times 2^32 plus the second.
    """
    per_block = blocks.select("block", "codes", "counts").mapInArrow(_pairs, "block long, code long, n long")
    counted = C.staged(per_block.groupBy("code").agg(F.sum("n").alias("n")).withColumn("b", F.col("code").bitwiseAND(0xFFFFFFFF)))
    highest = counted.groupBy("b").agg(F.max("n").alias("top"))
    return counted.join(highest, "b").select("code", "n", (F.col("n") == F.col("top")).alias("best"))


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = C.pa_schema(_RESULT)
    for batch in batches:
        for i in range(batch.num_rows):
            docs, codes, refs, n_links, answers = (batch.column(k)[i] for k in range(5))
            table = pa.ipc.open_stream(pa.py_buffer(docs.as_py())).read_all()
            n_codes = len(codes.as_py()) // 8
            place = np.frombuffer(refs.as_py(), np.uint32 if n_codes >> 16 else np.uint16)
            said = answers.values.flatten() if answers.is_valid else [pa.array([], pa.int64())] * 3
            code, n, best = (x.to_numpy(zero_copy_only=False) for x in said)
            order = np.argsort(code)
            totals = [np.concatenate([[0], np.cumsum(x[order].astype(np.int64)[place])]) for x in (n, best)] if n_codes else [np.zeros(1, np.int64)] * 2
            ends = np.concatenate([[0], np.cumsum(np.frombuffer(n_links.as_py(), np.int64))])
            columns = {name: table.column(name).combine_chunks() for name in table.schema.names}
            sums = {name: total[ends[1:]] - total[ends[:-1]] for name, total in zip(("count_sum", "n_best"), totals, strict=True)}
            yield C.record_batch(columns | sums, fields)


def blocks_of(docs: DataFrame, first: str, second: str, long: int = LONG, width: int = RANGE) -> DataFrame:
    """Staged blocks of aligned documents; see :func:`align`."""
    C.limit_batches(docs.sparkSession)
    paths, plain = (first, second), docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = plain.filter(size <= long).mapInArrow(_encode_docs(paths), _BLOCKS)
    return C.staged(short.unionByName(_long_blocks(plain.filter(size > long), paths, long, width)))


def align(docs: DataFrame, first: str, second: str, long: int = LONG, width: int = RANGE) -> DataFrame:
    """Per row of ``docs``: tokens of both tokenizers, common groups, links, and how common the links' pairs are.

    The first tokenizer (a byte-level BPE file) encodes space and text, the second (a piece model) the text, to which it adds
    the space. Columns: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. A link is a pair of tokens
    that end at one byte; ``count_sum`` adds the corpus-wide counts of the links' pairs of ids, ``n_best`` counts links
    whose pair is the most frequent one of its second id, ties included. Rows whose text is null or empty, or is not what
    the tokens of both spell, have zeros and an empty digest and link nothing. Repeated rows and rows with equal or
    null ids are rows of their own. Texts over ``long`` bytes are cut and composed; the result is the same.
    """
    blocks = blocks_of(docs, first, second, long, width)
    per_block = blocks.select("block", "codes", "counts").mapInArrow(_pairs, "block long, code long, n long").drop("n")
    told = per_block.join(linked_pairs(blocks), "code")
    answers = told.groupBy("block").agg(F.collect_list(F.struct("code", "n", "best")).alias("answers"))
    joined = blocks.drop("counts").join(answers, "block", "left")
    return joined.select("docs", "codes", "refs", "n_links", "answers").mapInArrow(_finish, _RESULT)

"""Documents with every awkward case, and plain re-statements of what the operators promise."""

import hashlib
import random
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard long, payload string, ref long, label string, key string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def documents(seed=1):
    """Rows of documents: nulls, empty and long texts, ties, repeated rows, copies, near copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["Été", "naïve", "ÜBER", "日本", "x"]
    passage = sentence(rng, 70, vocabulary)
    boiler = sentence(rng, 12, vocabulary)
    texts = [None, "", "  \n\t ", "one two", "one two", "One TWO", "one two three four", "!!! ### ...", "a" * 3000, "ab " * 700]
    long = sentence(rng, 6000, vocabulary)
    texts += [long, long + " end", passage + "\n" + passage]
    for _ in range(12):
        text = sentence(rng, rng.randint(30, 250), vocabulary)
        texts.append(text)
        if rng.random() < 0.5:
            texts.append(text)
        for _ in range(rng.randint(0, 4)):  # near copies, more and more different
            words = text.split(" ")
            for _ in range(rng.randint(1, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            texts.append(text)
    for _ in range(6):
        texts.append(sentence(rng, 40, vocabulary) + "  \n" + passage + "\r\n" + boiler + "\n" + sentence(rng, 25, vocabulary))
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "fr", None]), "s", 0, 7, "p", 1, "l", "k") for i, t in enumerate(texts)]
    rows += [rows[3], (None, sentence(rng, 50, vocabulary), None, None, None, None, None, None, None, None), (len(texts) + 9, long, "en", "s", 0, 7, "p", 1, "l", "k")]
    return rows


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return WORD.findall(text or "")


def shingles(text, k=5):
    found = words(lower(text or ""))
    if not found:
        return set()
    return {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))}


def groups(sets, percent=75):
    """Smallest position that links reach, by comparing every pair."""
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def without_windows(rows, k=20):
    """Words and removal flags per row, in order of id (null first) and row."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        found = words(rows[i][1])
        gone = [False] * len(found)
        for at in range(len(found) - k + 1):
            window = tuple(found[at : at + k])
            if window in seen:
                gone[at : at + k] = [True] * k
            seen.add(window)
        out[i] = (found, gone)
    return out


def repeated_bytes(texts, length):
    """Removal flags per text: bytes in a string of ``length`` bytes that starts in more than one place."""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(gone))
    return out


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n

import random
import re
import zlib
from collections import Counter

import pytest

from parcelight.llm import spelling

from .conftest import SCHEMA, row


def counted(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def misspelt(rng, word):
    at, c = rng.randrange(len(word)), rng.choice("aabÀßéÿ×")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + c + word[at:], word[:at] + c + word[at + 1:]])


def _texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÉést") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaab", "Straße", "STRASSE"]
    for _ in range(160):
        words.append(misspelt(rng, rng.choice(words)))
    texts = []
    for _ in range(200):
        picked = [words[int(rng.random() ** 2 * len(words))] for _ in range(30)]
        texts.append(rng.choice([" ", "-", "\n", "_9"]).join(w.upper() if rng.random() < .1 else w for w in picked))
    return texts


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 12), (3, 2)])
def test_equals_brute_force(spark, odd, seed, block, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TILE", 5)
    monkeypatch.setattr(spelling, "PACK", 11)
    monkeypatch.setattr(spelling, "HELD", 50)
    docs = odd.unionByName(
        spark.createDataFrame([row(i, t) for i, t in enumerate(_texts(seed))], SCHEMA)
    )
    expect = brute(counted(docs.collect()))
    out = spelling.variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len(out) == len(expect) and {tuple(r) for r in out} == expect
    assert sum(r.form is not None and r.root != r.form for r in out) > 3
    assert sum(r.n_near for r in out) > 200


def test_long_and_equal_words(spark):
    long = "w" * 30_000
    rows = [row(1, f"{long} {long}x {long} {long}")] * 3 + [row(2, None)] * 9
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r)[1:3] for r in spelling.variants(docs).collect()} == {(9, 1), (3, 1)}


@pytest.mark.parametrize("a, b, at", [
    ("abcde", "abcde", -1), ("abcde", "abXde", 2), ("abcde", "abcdef", 5), ("aaaab", "aaaaab", 4),
    ("abcde", "Yabcde", 0), ("abcde", "abdce", -1), ("abcde", "bcdefa", -1), ("abcdz", "abcde", 4),
])
def test_first_difference(a, b, at):
    assert spelling.first_difference(a, b) == at


def test_nothing(nothing):
    assert spelling.variants(nothing).count() == 0

import random

import numpy as np
import pytest

from parcelight.llm import near_copies

from .conftest import SCHEMA, odd_rows, row

# A vocabulary of which no 5-word run repeats by chance.
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrstx"]


def prose(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(rng, words, share):
    """Some words replaced, inserted or left out."""
    out = []
    for w in words:
        kind = rng.random() / share
        out += [w] if kind >= 1 else [[rng.choice(VOCABULARY)], [w, "added"], []][int(kind * 3)]
    return out


def similarity(a, b):
    a, b = (
        {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in (a, b)
    )
    return len(a & b) / len(a | b)


def distance(a, b):
    x, y = (np.frombuffer(near_copies.sketch(" ".join(t))[0], dtype=np.uint8) for t in (a, b))
    return int(np.bitwise_count(x ^ y).sum())


def test_distance_measures_similarity():
    rng = random.Random(1)
    shares = {0.9: 0.0, 0.8: 0.0, 0.6: 0.0}
    for s in shares:
        radius = near_copies.radius_for(0.8)
        hits = 0
        for _ in range(200):
            text = prose(rng, 400)
            # The end replaced: this many of the 396 runs stay.
            left = round(396 * 2 * s / (1 + s)) + 4
            other = text[:left] + prose(rng, 400 - left)
            assert abs(similarity(text, other) - s) < 0.01
            hits += distance(text, other) <= radius
        shares[s] = hits / 200
    assert shares[0.9] == 1 and 0.85 < shares[0.8] < 1 and shares[0.6] == 0


def labels(codes, group, radius):
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]).sum(axis=2) <= radius
    near &= group[:, None] == group[None, :]
    label = np.arange(len(codes))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("radius", [0, 1, 63, 64, 172])
def test_groups_against_all_pairs(radius):
    rng = np.random.default_rng(radius)
    sizes = [1, 2, 3, 64, 65, 5, 300, 40, 1, 130]
    codes, group = [], []
    for g, size in enumerate(sizes):
        base = rng.integers(0, 256, (max(1, size // 4), 128), dtype=np.uint8)
        own = base[rng.integers(0, len(base), size)]
        flips = rng.random((size, 1024)) < rng.choice([0, 0.0005, 0.05, 0.1], (size, 1))
        codes.append(own ^ np.packbits(flips, axis=1))
        group += [g] * size
    codes, group = np.concatenate(codes), np.array(group)
    found = near_copies.group_roots(codes, group, radius)
    assert (found == labels(codes, group, radius)).all()


@pytest.fixture(scope="module")
def planted(spark):
    """(rows, words by id, pairs of an original and its near copy)."""
    rng = random.Random(3)
    words, pairs = {}, []
    for i in range(400):
        words[i] = prose(rng, rng.choice([60, 150, 400, 900]))
    for i in range(400):
        j = 1000 + i
        words[j] = edited(rng, words[i], rng.choice([0.002, 0.01, 0.02, 0.03, 0.1, 0.3]))
        pairs.append((i, j, similarity(words[i], words[j])))
    for i in range(300):  # one large group of different near copies
        words[5000 + i] = edited(rng, words[399], 0.01)
    # A passage that unlike documents share.
    passage = prose(rng, 60)
    for i in range(60):
        words[7000 + i] = prose(rng, 150) + passage + prose(rng, 150)
    docs = spark.createDataFrame([row(i, " ".join(w)) for i, w in words.items()], SCHEMA)
    return docs.repartition(5).cache(), words, pairs


def test_near_copies_are_found_and_others_left_alone(planted):
    docs, words, pairs = planted
    found = {r.id: r.first_id for r in near_copies.with_components(docs).collect()}
    near = [(i, j) for i, j, s in pairs if s >= 0.8]
    assert len(near) > 150
    assert sum(found[i] == found[j] for i, j in near) >= 0.9 * len(near)
    assert not [1 for i, j, s in pairs if s < 0.6 and found[i] == found[j]]
    large = [i for i in words if 5000 <= i < 5300 and similarity(words[i], words[399]) >= 0.8]
    assert sum(found[i] == found[399] for i in large) >= 0.95 * len(large)
    assert all(found[i] == i for i in range(7000, 7060))
    # Whole groups: in a component, all have the smallest id, which is one of them.
    assert all(found[f] == f and f <= i for i, f in found.items())

    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))


def test_sub_blocks_change_nothing(planted):
    docs, _, _ = planted
    whole = near_copies.with_components(docs)
    cut = near_copies.with_components(docs, sub_block=16)
    assert sorted(whole.select("id", "first_id").collect()) == sorted(cut.select("id", "first_id").collect())


def test_odd_rows(spark, odd, nothing):
    kept = near_copies.keep_first(odd).collect()
    assert near_copies.keep_first(odd).schema == odd.schema
    expect = {r[0]: r[1] for r in odd_rows()}
    # 1 to 3 and a null id have no words; 7 (twice) and 8 are the same text.
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12]
    assert len(kept) == 10
    assert all(r.text == expect[r.doc_id] for r in kept if r.doc_id is not None)
    assert near_copies.keep_first(nothing).collect() == []


def test_repeated_ids_and_case(spark):
    rng = random.Random(9)
    text = " ".join(prose(rng, 80))
    rows = [(1, "other words here"), (1, "again something else"), (2, text.upper()), (2, text), (3, "  " + text)]
    kept = near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 1, 2]


def test_very_long_text(spark):
    rng = random.Random(10)
    long = prose(rng, 200_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[:-2000])), (3, " ".join(long[:90_000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near_copies.keep_first(docs).collect()) == [1, 3]

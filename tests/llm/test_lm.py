import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from parcelight.llm import lm

from .conftest import SCHEMA, odd_rows, prose, row

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def subwords():
    return lm.Subwords(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def parameters():
    return np.random.default_rng(1).normal(size=lm.SIZE) * 0.3


def test_gradients(parameters):
    rng = np.random.default_rng(2)
    p = lm.unpacked(parameters.copy())
    rows = rng.integers(0, lm.SHAPES["vectors"][0], (3, lm.WINDOW))
    present = rng.random((3, lm.WINDOW)) > 0.2
    present[:, lm.CONTEXT :] = True
    previous, target = rng.integers(0, lm.CLASSES, (2, 3, lm.SCORED))
    scored = rng.random((3, lm.SCORED)) > 0.3

    def loss():
        found = lm.log_probabilities(p, rows, present, previous, target)
        return -(found * scored).sum() / scored.sum()

    exact = lm.gradients(p, rows, present, previous, target, scored)
    for name, shape in lm.SHAPES.items():
        for _ in range(5):
            at = tuple(rng.integers(0, s) for s in shape)
            if name == "vectors":
                at = (rows[0, rng.integers(lm.WINDOW)], at[1])
            value = p[name][at]
            p[name][at] = value + 1e-4
            above = loss()
            p[name][at] = value - 1e-4
            below = loss()
            p[name][at] = value
            assert exact[name][at] == pytest.approx((above - below) / 2e-4, abs=1e-7)


def test_no_place_sees_what_follows(parameters):
    rng = np.random.default_rng(3)
    p = lm.unpacked(parameters)
    rows = rng.integers(0, lm.OWN_VECTORS, (1, lm.WINDOW))
    present = np.ones((1, lm.WINDOW), dtype=bool)
    zero = np.zeros((1, lm.SCORED), dtype=np.int64)
    before = lm.log_probabilities(p, rows, present, zero, zero)
    rows[0, 20:] = 7
    after = lm.log_probabilities(p, rows, present, zero, zero)
    seen = 20 - lm.CONTEXT
    assert np.allclose(before[0, :seen], after[0, :seen]) and not np.allclose(before, after)


@pytest.mark.parametrize("n", [0, 1, 22, 23, 24, 25, 47, 48, 100])
def test_each_subword_is_scored_once_with_context(n):
    inputs, targets = lm.windows_of(np.arange(n), 900, 901)
    scored = targets[targets >= 0].tolist()
    assert scored == [*range(n), 901]
    whole = [900, *range(n)]
    for w, (given, wanted) in enumerate(zip(inputs, targets)):
        for place, target in enumerate(wanted):
            if target >= 0:
                position = lm.SCORED * w + place
                own = [x for x in given[: lm.CONTEXT + place + 1] if x >= 0]
                assert own == whole[: position + 1][-len(own) :]
                assert len(own) >= min(position + 1, lm.CONTEXT + 1)


def test_class_probabilities_sum_to_one(subwords):
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 50, subwords.count + 2)
    classes = lm.classes_of(subwords, counts)
    share = np.bincount(classes.of[:-2], weights=10 ** classes.log_share[:-2], minlength=lm.CLASSES)
    share[classes.of[subwords.end]] += 10 ** classes.log_share[subwords.end]
    assert np.allclose(share[share > 0], 1)
    ids = np.array([5, 9, 700, 5, 9, 41, 5, 9, 700])
    contexts = lm.contexts_of(ids, np.array([3, 3, 3]))
    keys, n = np.unique(np.concatenate([c[c >= 0] << 32 | ids[c >= 0] for c in contexts]),
                        return_counts=True)
    shares = lm.Pairs(keys, n).within(classes)
    every = np.r_[0 : subwords.count, subwords.end]
    for at in (1, 2):  # after one subword, after two
        around = [np.full(len(every), c[at]) for c in contexts]
        given = 10 ** shares.log_share(classes, every, around)
        whole = np.bincount(classes.of[every], weights=given, minlength=lm.CLASSES)
        assert np.allclose(whole[whole > 0], 1)


def test_words_encoded_together_or_alone(subwords):
    rng = random.Random(5)
    words = [w.encode() for w in prose(rng, 300).split()]
    words += ["é\x85".encode(), "\xa0".encode(), "\xa0\xa0".encode(), b"a\x1cb", "日本".encode(), b"", b"x" * 5000]
    ids, sizes = subwords.of_words(words, at_once=37)
    ends = np.cumsum(sizes)
    for w, end, size in zip(words, ends, sizes):
        assert ids[end - size : end].tolist() == (subwords.ids(w) if w else [])


def test_words_of_texts():
    texts = [None, "", " \t\r\n\x0b\x0c", "A b\tÄB\x85c\n", "  x", "x  y ", "\x1c"]
    words, index, sizes = lm.split_words(pa.array(texts))
    expect = [t.encode().lower().split() if t else [] for t in texts]
    assert sizes.tolist() == [len(e) for e in expect]
    assert [words[i] for i in index] == [w for e in expect for w in e]


def _base(texts, learning):
    words = {i: (t or "").encode().lower().split() + [b""] for i, t in texts.items()}
    counts = Counter(w for i in learning for w in words[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ws), sum(w in counts for w in ws), n,
                sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for i, ws in words.items()}


@pytest.mark.parametrize("frequent", [1 << 18, 4])
def test_base_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "REMEMBERED", 60)
    rng = random.Random(8)
    rows = [r for r in odd_rows() if r[0] is not None and r[0] != 7]
    rows += [row(100 + i, prose(rng, rng.randint(0, 60))) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learning = docs.where("doc_id % 3 <> 0")
    out = lm.score(docs, learning, PATH, public_tokenizers.PATTERN).collect()
    texts = {r[0]: r[1] for r in rows}
    expect = _base(texts, [i for i in texts if i % 3])
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_tokens, r.n_known, r.train_tokens) == expect[r.doc_id][:3]
        assert r.base_score == pytest.approx(expect[r.doc_id][3])
        assert math.isfinite(r.score) and r.score < 0


def test_scores_equal_the_model_text_by_text(spark, subwords, monkeypatch):
    """Small windows of one text at a time, each with its own softmax."""
    kept = {}
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda w, c, **kw: kept.setdefault("p", fit(w, c, **kw)))
    within = lm.Pairs.within
    monkeypatch.setattr(lm.Pairs, "within", lambda self, c: kept.setdefault("s", (c, within(self, c)))[1])
    rng = random.Random(9)
    rows = [row(i, prose(rng, rng.randint(0, 40))) for i in range(40)] + [row(50, None), row(50, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    out = {r.doc_id: r.score for r in lm.score(docs, docs, PATH, public_tokenizers.PATTERN).collect()}
    classes, shares = kept["s"]
    p = lm.unpacked(kept["p"].astype(np.float64))
    for r in rows[:10] + rows[-1:]:
        words = (r[1] or "").encode().lower().split()
        each = [subwords.ids(w) for w in words]
        ids = [i for e in each for i in e]
        total = 0.0
        inputs, targets = lm.windows_of(np.array(ids, dtype=np.int64), subwords.begin, subwords.end)
        for given, wanted in zip(inputs, targets):
            rows_, present, previous, target, scored = lm._prepared(
                classes, given[None, :], wanted[None, :])
            found = lm.log_probabilities(p, rows_, present, previous, target)
            total += found[scored].sum() / math.log(10)
        for e in each:
            flat = np.array(e, dtype=np.int64)
            total += shares.log_share(classes, flat, lm.contexts_of(flat, np.array([len(e)]))).sum()
        assert out[r[0]] == pytest.approx(total, abs=1e-3)


def test_every_window_of_a_text_teaches(spark, subwords):
    rng = random.Random(14)
    texts = [None, "", prose(rng, 5), prose(rng, 3000), *(prose(rng, n) for n in range(20, 60))]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    _, windows = lm.corpus(docs, subwords, "text")
    found = [lm.unfolded(pa.array([r.window], pa.list_(pa.int32())), subwords.end)
             for r in windows.collect()]
    taught = sorted((a.tolist(), b.tolist()) for part in found for a, b in zip(*part))
    expect = []
    for t in texts:
        words = (t or "").encode().lower()
        ids = np.array(subwords.ids(words) if words else [], dtype=np.int64)
        cut = lm.windows_of(ids, subwords.begin, subwords.end)
        expect += [(a.tolist(), b.tolist()) for a, b in zip(*cut)]
    assert taught == sorted(expect) and len(expect) > 3000 // lm.SCORED


@pytest.mark.parametrize("frequent", [1 << 18, 4])
def test_scores_do_not_depend_on_what_is_sent(spark, monkeypatch, frequent):
    """A few pairs broadcast, the others joined, or all broadcast: equal scores."""
    rng = random.Random(13)
    rows = [row(i, " ".join(prose(rng, 1) + rng.choice("abcdefgh") * rng.randint(0, 9) + str(rng.randint(0, 999))
                            for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [row(90, None), row(91, "w" * 3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learning = docs.where("doc_id % 3 <> 0")
    given = np.random.default_rng(1).normal(size=lm.SIZE).astype(np.float32) * 0.1
    monkeypatch.setattr(lm, "fit", lambda w, c, **kw: given)
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    found = []
    for pairs in (1 << 19, 40, 1):
        monkeypatch.setattr(lm, "PAIRS", pairs)
        monkeypatch.setattr(lm, "REMEMBERED", 1 << 19 if pairs == 40 else 60)
        out = lm.score(docs, learning, PATH, public_tokenizers.PATTERN)
        found.append({r.doc_id: (r.n_known, r.base_score, r.score) for r in out.collect()})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for i, expect in found[0].items():
            assert other[i] == pytest.approx(expect, abs=2e-6)


def test_training_helps_on_held_out_text(spark):
    rng = random.Random(10)
    rows = [row(i, " ".join(["red green blue white"] * rng.randint(5, 9))) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    out = lm.score(docs, docs.where("doc_id % 5 <> 1"), PATH, public_tokenizers.PATTERN)
    held = out.where("doc_id % 5 = 1").collect()
    assert all(r.score > r.base_score for r in held)  # it has learnt the order


def test_nothing(spark, odd, nothing):
    args = (PATH, public_tokenizers.PATTERN)
    assert lm.score(nothing, odd, *args).count() == 0
    rows = lm.score(odd, nothing, *args).collect()
    assert len(rows) == odd.count()
    assert all(r.base_score == pytest.approx(0, abs=1e-6) and r.train_tokens == 0 and r.n_known == 0 for r in rows)


def test_batches_share_their_memory_and_not_their_numbers():
    """A batch in arrays another has left has the same gradients, bit by bit, and asks for
    no new arrays; equal rows are summed in order."""
    rng = np.random.default_rng(5)
    p = lm.unpacked((rng.normal(size=lm.SIZE) * 0.1).astype(np.float32))

    def batch(n):
        shape = (n, lm.SCORED)
        return (
            rng.integers(0, 40, (n, lm.WINDOW)), rng.random((n, lm.WINDOW)) < 0.9,
            rng.integers(0, lm.CLASSES, shape), rng.integers(0, lm.CLASSES, shape),
            rng.random(shape) < 0.9,
        )

    room = lm.Room()
    lm.gradients(p, *batch(20), room)
    held = {name: id(v) for name, v in room.held.items()}
    for n in (20, 3, 11):
        given = batch(n)
        alone, shared = lm.gradients(p, *given), lm.gradients(p, *given, room)
        assert all(np.array_equal(alone[name], shared[name]) for name in lm.SHAPES)
        told = lm.log_probabilities(p, *given[:4], room)
        assert np.array_equal(told, lm.log_probabilities(p, *given[:4]))
    assert {name: id(v) for name, v in room.held.items()} == held
    at, rows = rng.integers(0, 7, 500), rng.normal(size=(500, 16)).astype(np.float32)
    one_by_one = np.zeros((9, 16), dtype=np.float32)
    for i, row in zip(at, rows):
        one_by_one[i] += row
    assert np.array_equal(lm._summed_rows(at, rows, 9, room), one_by_one)


def test_only_what_is_out_of_range_is_clipped(monkeypatch):
    """Batches in range, as all are in practice, are not passed over once more; others
    have the limits they had, and places without a subword have no weight in any."""
    rng = np.random.default_rng(6)
    shape = (4, lm.SCORED)
    x, present = rng.integers(0, 40, (4, lm.WINDOW)), rng.random((4, lm.WINDOW)) < 0.8
    present[0] = present[:, lm.CONTEXT] = True
    previous, target = rng.integers(0, lm.CLASSES, (2, *shape))
    clipped, minimum = [], np.minimum
    monkeypatch.setattr(np, "minimum", lambda *a, **kw: clipped.append(a[1]) or minimum(*a, **kw))
    for large, limits in ((1, []), (300, [60, 80])):
        p = lm.unpacked(rng.normal(size=lm.SIZE) * 0.3)
        p["vectors"] *= large**0.5
        p["output"] *= large
        clipped.clear()
        found = lm.log_probabilities(p, x, present, previous, target)
        assert clipped == limits
        inputs = p["vectors"][x] + p["places"]
        own = inputs[:, lm.CONTEXT :]
        weight = np.exp(minimum(own @ p["query"] / 4 @ (inputs @ p["key"]).transpose(0, 2, 1), 60))
        weight = weight * np.tri(lm.WINDOW)[lm.CONTEXT :] * present[:, None, :]
        seen = weight @ (inputs @ p["value"]) / (weight.sum(axis=-1, keepdims=True) + 1e-20)
        logits = (seen @ p["mixed"] + own) @ p["output"] + p["bigram"][previous]
        chosen = np.take_along_axis(logits, target[..., None], axis=-1)[..., 0]
        expect = chosen - np.log(np.exp(minimum(logits, 80)).sum(axis=-1))
        assert np.allclose(found, expect)


def test_maxima_by_halves():
    rng = np.random.default_rng(8)
    values = rng.normal(size=(50, lm.CLASSES)).astype(np.float32)
    values[3], values[4, 9], values[5, 63] = -np.inf, np.nan, np.inf
    found = lm._row_maxima(values, lm.Room())
    assert np.array_equal(found, values.max(axis=1, keepdims=True), equal_nan=True)

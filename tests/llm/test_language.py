import random

import numpy as np
import public_tokenizers
import pytest

from parcelight.llm import language

from .conftest import SCHEMA, row

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = ["▁", "a", "b", "ab", "▁a", "abc", "c", "ba", "▁ba", "x" * 20, "A"]


def _segmentations(pieces, text):
    if not text:
        yield []
        return
    for end in range(1, min(len(text), language.LONGEST_PIECE) + 1):
        if text[:end] in pieces.number:
            for rest in _segmentations(pieces, text[end:]):
                yield [pieces.number[text[:end]], *rest]
    if text[0] not in pieces.number:
        for rest in _segmentations(pieces, text[1:]):
            yield [-1, *rest]


@pytest.mark.parametrize("long_word", [40, 3, 1])
def test_every_segmentation_counts(monkeypatch, long_word):
    monkeypatch.setattr(language, "LONG_WORD", long_word)
    pieces = language.Pieces(PIECES)
    rng = np.random.default_rng(0)
    shares = rng.random((pieces.count, 3))
    shares /= shares.sum(axis=0)
    words = ["a", "ab", "abcab", "zab", "bababc", "abcabzabc", "zz"]
    known = language._with_unknown(shares)
    whole, uses = [], np.zeros((pieces.count + 1, 3))
    counts = rng.integers(0, 5, (len(words), 3)).astype(float)
    for word, n in zip(words, counts):
        found = [(s, np.prod(known[s], axis=0)) for s in _segmentations(pieces, "▁" + word)]
        whole.append(sum(p for _, p in found))
        for s, p in found:
            for piece in s:
                uses[piece] += n * p / whole[-1]
    assert np.allclose(np.exp(language.log_likelihoods(pieces, words, shares)), whole)
    assert np.allclose(language.expected_uses(pieces, words, counts, shares), uses[:-1])


def test_a_very_long_word_does_not_underflow():
    pieces = language.Pieces.read(PATH)
    shares = np.full((pieces.count, 2), 1 / pieces.count)
    found = language.log_likelihoods(pieces, ["ab" * 5000, "ab" * 30], shares)
    assert np.isfinite(found).all() and found[0, 0] < -10_000


def test_rounds_raise_the_likelihood(spark):
    rng = random.Random(1)
    rows = [row(i, " ".join("".join(rng.choice("abcd") for _ in range(5)) for _ in range(30)))
            for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    words = [w for r in rows for w in language.words_in(r[1])]
    scores = []
    for rounds in (0, 1, 3):
        model = language.fit(docs, PATH, rounds=rounds)
        scores.append(language.log_likelihoods(model.pieces, words, model.shares).sum())
    assert scores == sorted(scores)


SYLLABLES = {"en": "th er on an ing ed", "fr": "eau oi ez que ou ai", "de": "sch ung ein keit ber pf"}


def _corpus(spark, n=120):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        parts = SYLLABLES[lang].split()
        text = " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(40))
        rows.append(row(i, text, lang))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_held_out_accuracy(spark):
    docs = _corpus(spark)
    model = language.fit(docs.where("doc_id % 4 <> 2"), PATH)
    assert model.languages == ["de", "en", "fr"]
    out = language.with_language(docs.where("doc_id % 4 = 2"), model, names=("lang_pred", "sure"))
    rows = out.collect()
    assert all(r.lang_pred == r.lang and 0 < r.sure <= 1 for r in rows) and len(rows) == 30


def test_odd_rows(spark, odd, nothing):
    model = language.fit(_corpus(spark).unionByName(odd), PATH)
    out = language.with_language(odd, model, names=("lang_pred", "sure")).collect()
    assert len(out) == odd.count()
    for r in out:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.sure <= 1
    assert language.with_language(nothing, model, names=("p", "s")).count() == 0
    untaught = language.fit(nothing, PATH)
    assert {r.lang_pred for r in language.with_language(odd, untaught, names=("lang_pred", "s"))
            .collect()} == {"und"}


def test_a_bounded_table_changes_nothing(spark, monkeypatch):
    docs = _corpus(spark, 30)
    model = language.fit(docs, PATH)
    texts = [r.text for r in docs.collect()]
    whole = language.Scorer(model).scores(texts)
    monkeypatch.setattr(language, "REMEMBERED", 5)
    few = language.Scorer(model)
    assert [few.scores([t])[0] for t in texts] == whole


def test_numerals_are_no_letters_and_clashing_columns_are_replaced(spark, odd):
    model = language.fit(_corpus(spark, 30), PATH)
    assert language.words_in("½ ² ① x² ٣") == ["x²"]
    docs = odd.select("doc_id", "text", "score").limit(0).unionByName(
        spark.createDataFrame([(1, "½ ² ①", 9.0), (2, "abc", 9.0)], "doc_id bigint, text string, score double"))
    out = {r.doc_id: r for r in language.with_language(docs, model).collect()}
    assert (out[1].lang_pred, out[1].score) == ("und", 0.0) and out[2].score <= 1

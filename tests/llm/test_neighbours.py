import random

import numpy as np
import pytest

from parcelight.llm import neighbours

from .conftest import SCHEMA, prose, row


def _corpus(spark, n=200):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text, bad = prose(rng, rng.randint(30, 90)), i % 4 == 0
        if bad:
            text = rng.choice([text.upper(), text.replace(" ", "*** "), " ".join(["word"] * 50)])
        rows.append(row(i, text))
        labels.append((i, 0 if bad else 1))
    return (spark.createDataFrame(rows, SCHEMA).repartition(3),
            spark.createDataFrame(labels, "doc_id bigint, quality int"))


def test_votes_equal_brute_force(spark):
    docs, labels = _corpus(spark)
    model = neighbours.fit(docs, labels.where("doc_id % 2 = 0"))
    out = neighbours.with_score(docs, model, "text", "found").collect()
    for r in out[:60]:
        mine = model.directions(neighbours.term_shares(r.text)[None, :])[0]
        near = np.array([round(float(mine @ v), 9) for v in model.vectors])
        last = sorted(near)[-neighbours.NEIGHBOURS]
        votes = np.where(near >= last, np.maximum(near, 0), 0)
        assert r.found == pytest.approx(float(votes @ model.labels / votes.sum()), abs=1e-5)


def test_frequencies_cover_all_documents(spark):
    docs, _ = _corpus(spark)
    n, frequency = neighbours.document_frequencies(docs, "text")
    shares = np.array([neighbours.term_shares(r.text) for r in docs.collect()])
    assert n == 200 and (frequency == (shares > 0).sum(axis=0)).all()


def test_held_out_accuracy(spark):
    docs, labels = _corpus(spark)
    model = neighbours.fit(docs, labels.where("doc_id % 5 <> 0"))
    out = neighbours.with_score(docs.where("doc_id % 5 = 0"), model, "text", "found").collect()
    right = [(r.found >= neighbours.THRESHOLD) == (r.doc_id % 4 != 0) for r in out]
    assert len(right) == 40 and np.mean(right) >= 0.95


def test_the_number_of_labelled_documents_is_bounded(spark):
    docs, labels = _corpus(spark)
    assert len(neighbours.fit(docs, labels, limit=17).labels) == 17


def test_repeated_and_missing_labels(spark):
    docs, labels = _corpus(spark, 40)
    extra = spark.createDataFrame([(1, 0), (None, 1), (2, None), (999, 1)], labels.schema)
    model = neighbours.fit(docs.union(docs), labels.union(extra))
    assert len(model.labels) == 40 and sorted(set(model.labels)) == [0.0, 0.5, 1.0]


def test_odd_rows(spark, odd, nothing):
    docs, labels = _corpus(spark, 60)
    model = neighbours.fit(docs, labels)
    rows = neighbours.with_score(odd, model, "text", "found").collect()
    assert len(rows) == odd.count() and all(0 <= r.found <= 1 for r in rows)
    prior = sum(r.quality for r in labels.collect()) / 60
    assert all(r.found == pytest.approx(prior) for r in rows if not r.text)
    kept = neighbours.keep_good(odd, labels)
    assert kept.columns == odd.columns and {r.score for r in kept.collect()} <= {7.0}
    unlearnt = neighbours.fit(odd, labels.where("false"))
    assert neighbours.with_score(odd, unlearnt, "text", "f").where("f = 1.0").count() == odd.count()
    assert neighbours.with_score(nothing, model, "text", "f").count() == 0
    assert neighbours.fit(nothing, labels.where("false")).prior == 1.0

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.llm import quality_rules as rules

from .conftest import SCHEMA, prose, row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    seen, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def _texts():
    rng = random.Random(2)
    texts = [prose(rng, n) for n in (1, 2, 3, 4, 49, 50, 51, 400)]
    texts += ["a b c a b c", "a a a a", "x\ny\nx\n\n \nx ", "#1 *2 a|b <c> 5% $ &", "é\x85ü z"]
    texts += ["\n".join(prose(rng, 3) for _ in range(30)) + "\n" + "again and again\n" * 3]
    texts += [" ".join(rng.choice("abc") for _ in range(200)) for _ in range(5)]
    return texts


def test_counts(spark, odd):
    docs = odd.unionByName(spark.createDataFrame(
        [row(100 + i, t) for i, t in enumerate(_texts())], SCHEMA))
    by_id = collections.defaultdict(set)
    for r in docs.collect():
        by_id[r.doc_id].add(_counts(r.text))
    out = rules.quality_rules(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert counts in by_id[r.doc_id]
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def _mahalanobis(x, mean, cov):
    d = x - mean
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def _brute_force(x):
    """Concentration steps from both starts, with the operator's buckets."""
    floor = np.diag(np.square(rules.FLOORS))
    median = np.array([sorted(c)[(len(c) - 1) // 2] for c in x.T])
    deviation = [sorted(np.abs(c - m))[(len(c) - 1) // 2] for c, m in zip(x.T, median)]
    starts = [(x.mean(axis=0), np.cov(x.T, bias=True) + floor),
              (median, np.diag(np.square(np.array(deviation) * 1.4826)) + floor)]
    found = []
    for mean, cov in starts:
        for _ in range(rules.MAX_STEPS):
            bucket = np.floor(np.log2(_mahalanobis(x, mean, cov) + 1e-9) * rules.BUCKETS)
            cut = np.sort(bucket)[int(np.ceil(rules.SUPPORT * len(x))) - 1]
            inner = x[bucket <= cut]
            mean, cov = inner.mean(axis=0), np.cov(inner.T, bias=True) + floor
        found.append((np.linalg.slogdet(cov)[1], mean, cov))
    _, mean, cov = min(found, key=lambda f: f[0])
    d2 = _mahalanobis(x, mean, cov)
    half = np.sort(np.floor(np.log2(d2 + 1e-9) * rules.BUCKETS))[int(np.ceil(len(x) / 2)) - 1]
    return np.sqrt(d2 / max(1.0, 2.0 ** ((half + 1) / rules.BUCKETS) / rules.MEDIAN))


def _vector(counts, text):
    words, chars, symbols, dup, again = counts
    lines = len([x for x in text.split("\n") if WORD.search(x)])
    upper = len(re.findall("[A-Z]", text))
    return [np.log1p(words), np.log1p(chars / max(words, 1)), np.sqrt(symbols / max(chars, 1)),
            np.sqrt(dup / max(lines, 1)), np.sqrt(again / max(words, 1)), np.sqrt(upper / max(chars, 1))]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        text = "\n".join(prose(rng, rng.randint(20, 60)).capitalize() for _ in range(rng.randint(2, 9)))
        source = "a" if i % 3 else "b"
        if i % 20 == 7:
            text = " ".join(w + rng.choice(["***", "###", "$$$"]) for w in text.split())
        if i % 20 == 13:
            text = text.upper()
        rows.append(row(i, text, "en", source))
    rows += [row(1000 + i, prose(rng, 70), "fr", f"s{i}") for i in range(70)]  # judged by their language
    rows += [row(2000 + i, prose(rng, 70), f"l{i}", "a") for i in range(5)]  # judged by all rows
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_distances_equal_brute_force(corpus):
    groups = {"a": [], "b": [], "fr": [], "all": []}
    out = {r.doc_id: r for r in rules.quality_rules(corpus).collect()}
    for r in corpus.orderBy("doc_id").collect():
        groups["all"].append(r)
        if r.doc_id < 2000:
            groups["fr" if r.lang == "fr" else r.source].append(r)
    for name, rows in groups.items():
        fits = [r for r in rows if not out[r.doc_id].base_failed]
        x = np.array([_vector(_counts(r.text), r.text) for r in fits])
        expect = _brute_force(x).tolist()
        judged = [i for i, r in enumerate(fits) if name != "all" or r.doc_id >= 2000]
        assert judged and [out[fits[i].doc_id].distance for i in judged] == pytest.approx(
            [expect[i] for i in judged], rel=1e-6)


def test_junk_goes_and_prose_stays(corpus):
    out = rules.quality_rules(corpus).where("doc_id < 400 AND NOT base_failed")
    junk = F.col("doc_id") % 20 == 7
    shout = F.col("doc_id") % 20 == 13
    assert out.where(junk | shout).where("kept").count() == 0
    assert out.where(~junk & ~shout).where("NOT kept").count() == 0


def test_a_third_of_identical_junk_does_not_hide_itself(spark):
    rng = random.Random(15)
    rows = [row(i, "\n".join(prose(rng, rng.randint(20, 60)).capitalize() for _ in range(rng.randint(2, 9))))
            for i in range(200)]
    junk = " ".join(w + "###" for w in prose(rng, 120).split())
    rows += [row(1000 + i, junk) for i in range(100)]
    out = rules.quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(4)).where("NOT base_failed")
    assert out.where("doc_id >= 1000").count() == 100
    assert out.where("doc_id >= 1000 AND kept").count() == 0
    assert out.where("doc_id < 1000 AND NOT kept").count() == 0


def test_repeated_lines_go(spark):
    """Documents that say every line twice, beside ones that do not, and one small
    source of them beside large ones."""
    rng = random.Random(21)
    lines = lambda n: [prose(rng, rng.randint(8, 20)).capitalize() for _ in range(n)]
    rows = [row(i, "\n".join(lines(rng.randint(8, 25))), "en", rng.choice("ab")) for i in range(600)]
    for i in range(24):
        said = lines(rng.randint(4, 9))
        rows.append(row(1000 + i, "\n".join(said * 4), "en", "a" if i % 2 else "small"))
    out = rules.quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(4))
    judged = out.where("doc_id >= 1000").collect()
    assert len(judged) == 24 and not any(r.kept for r in judged)
    assert out.where("doc_id < 1000 AND NOT kept").count() == 0


def test_filter_keeps_columns_and_agrees(corpus, odd, nothing):
    for docs in (corpus, odd):
        kept = rules.keep_good(docs)
        assert kept.schema == docs.schema
        verdicts = rules.quality_rules(docs).where("kept")
        key = lambda df: sorted(str(r.doc_id) for r in df.collect())
        assert key(kept) == key(verdicts)
    assert rules.quality_rules(nothing).count() == 0 and rules.keep_good(nothing).count() == 0

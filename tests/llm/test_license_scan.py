import random
import re

from parcelight.llm import license_scan as scan

from .conftest import SCHEMA, row

def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered)


def brute(text):
    w = words(text)
    base, labels, score, starts = [], set(), 0.0, []
    for _, wording, label, phrase, is_base, run in scan.template_rows():
        t = words(wording)
        runs = len(t) - run + 1
        if phrase:
            places = [i for i in range(len(w) - len(t) + 1) if w[i:i + len(t)] == t]
            if places:
                labels.add(label)
                score = 1.0
            if is_base:
                starts += places
                base += [label] * bool(places)
            continue
        votes = {}
        for j in range(runs):
            for i in range(len(w) - run + 1):
                if w[i:i + run] == t[j:j + run]:
                    votes.setdefault(i - j, []).append((i, j))
        spans, last = [], None
        for diagonal in sorted(votes):
            if last is None or diagonal - last > scan.GAP:
                spans.append([])
            spans[-1] += votes[diagonal]
            last = diagonal
        for span in spans:
            share = len({j for _, j in span}) / runs
            score = max(score, share)
            length = max(i for i, _ in span) + run - min(i for i, _ in span)
            if share >= scan.SHARE and length <= scan.STRETCH * len(t):
                labels.add(label)
    return (
        len(w), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(set(base))), ",".join(sorted(labels)), score,
    )


def _texts():
    rng = random.Random(7)
    filler = "the of license public and software apache gnu general by cc mit permission".split()
    notices = [words(t) for _, t, _, phrase, _, _ in scan.template_rows() if not phrase]
    texts = []
    for i in range(120):
        w = [rng.choice(filler) for _ in range(rng.randint(0, 60))]
        if i % 2:
            t = list(rng.choice(notices))
            for _ in range(rng.randint(0, 9)):  # words changed, put in, left out
                at = rng.randrange(len(t))
                t[at:at + rng.randint(0, 1)] = rng.choices(filler, k=rng.randint(0, 3))
            at = rng.randint(0, len(w))
            w[at:at] = t[rng.randint(0, len(t) // 2):] if i % 6 == 1 else t
        texts.append(rng.choice([" ", ", ", "\n"]).join(w).title() if i % 5 == 0 else " ".join(w))
    return texts + [
        "CC BY CC-BY cc.by", "MIT MIT License license", "MIT Lİcense mit licenſe",
        "GNU General PublicK License", "Licensed under CC BY-NC 4.0.", "mit\x00license",
    ]


def test_equals_brute_force(spark, odd):
    texts = _texts()
    docs = odd.unionByName(
        spark.createDataFrame([row(100 + i, t) for i, t in enumerate(texts)], SCHEMA)
    )
    expect = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    got = sorted((tuple(r) for r in scan.scan(docs).collect()), key=str)
    assert got == expect
    assert len({g[6] for g in got}) > 8  # labels of many kinds


def test_every_notice_is_told_from_the_others(spark):
    rows = [(i, t) for i, t, *_ in scan.template_rows()]
    found = {r.id: r.labels for r in scan.scan(
        spark.createDataFrame(rows, "id int, text string"), "id"
    ).collect()}
    for i, _, label, *_ in scan.template_rows():
        assert label in found[i].split(",")
        assert len(set(found[i].split(","))) <= 2


def test_notice_with_changes_is_one_span(spark):
    notice = words(scan.NOTICES[0][0])
    changed = ["prose"] * 9 + notice[:30] + ["put", "in"] + notice[30:50] + notice[53:] + ["end"]
    (span,) = scan.spans(spark.createDataFrame([(1, " ".join(changed))], "doc_id int, text string")).collect()
    assert (span.label, span.first_word, span.last_word) == ("mit", 9, len(changed) - 2)
    assert 0.8 < span.share < 1 and not span.phrase


def test_nothing(nothing):
    assert scan.scan(nothing).count() == 0


def test_no_python_workers(spark, odd):
    plan = scan.scan(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "MapIn" not in plan


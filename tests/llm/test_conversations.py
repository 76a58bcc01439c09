import hashlib
import random
import re
from functools import lru_cache

import pytest

from parcelight.llm import conversations as c
from parcelight.llm.queries import damaged_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, conv int, _no int"
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}
AFTER = {"s": 1, "u": 2, "a": 3}


def faults_of(turns):
    seen, out = set(), []
    for role, text in turns:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns):
    """By the rest of the turns, whole strings compared, turns put in one by one."""
    faults = faults_of(turns)

    @lru_cache(None)
    def rest(i, state, put):
        found = []
        if i == len(turns):
            if state in (0, 3):
                found.append((0, "", ()))
        else:
            role, text = turns[i]
            cost, letters, out = rest(i + 1, state, 0)
            found.append((cost + 2, "D" + letters, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                if role[:1] and role[:1] in NEXT[state]:
                    cost, letters, out = rest(i + 1, AFTER[role[:1]], 0)
                    found.append((cost + extra, "K" + letters, ((role, text), *out)))
                for new in ("user", "assistant"):
                    if new[0] in NEXT[state]:
                        cost, letters, out = rest(i + 1, AFTER[new[0]], 0)
                        found.append((cost + extra + 1, "R" + letters, ((new, text), *out)))
        if put < 3:
            for new in ("user", "assistant"):
                if new[0] in NEXT[state]:
                    cost, letters, out = rest(i, AFTER[new[0]], put + 1)
                    found.append((cost + 5, "I" + letters, ((new, ""), *out)))
        return min(found, default=(10**9, "", ()))

    return rest(0, 0, 0)


def brute(rows):
    convs = {}
    for r in rows:
        convs.setdefault(r.conv_id, []).append(
            (r.turn is not None, r.turn or 0, " " if r.role is None else r.role,
             " " if r.text is None else r.text))
    out = {}
    for conv, found in convs.items():
        found.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        turns = [t[2:] for t in found]
        numbers = [t[1] for t in found if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults = faults_of(turns)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, letters, left = cheapest(turns)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     illegal, cost, letters, digest)
    return out


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "student", "User"]
TEXTS = ["Yes.", "No", "", " \t", "So?", "Éé 🙂!", "Long ago.  \n", None, "end .x", "one!", "two."]


def _rows(seed, conversations=40, most=14):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(rng.randint(1, most)):
            text = rng.choice(TEXTS) if rng.random() < 0.6 else f"{rng.random()}."
            number = rng.choice([turn, turn, turn, turn * 2, None, 1])
            rows.append((conv, number, rng.choice(ROLES[:5] if rng.random() < .7 else ROLES), text, "x", 1, 2))
    return rows


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 3), (3, 7), (4, 1)])
def test_equals_brute_force(spark, seed, block, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", block)
    rows = spark.createDataFrame(_rows(seed), SCHEMA).repartition(3)
    expect = brute(rows.collect())
    reports, turns = c.repair(rows)
    digests = {r.conv: r.sha256 for r in c.digests(turns).collect()}
    got = {
        r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests[r.conv])
        for r in reports.collect()
    }
    assert got == expect and reports.count() == len(expect) == len(digests)


@pytest.mark.parametrize("prime", [c._PRIME, 3])
def test_solver_in_pieces(prime, monkeypatch):
    """With a tiny modulus hashes collide all the time: nothing may change."""
    monkeypatch.setattr(c.Audits.__init__, "__defaults__", (prime,))
    rng = random.Random(8)
    for _ in range(150):
        turns = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", f"{rng.random()}!"]))
                 for _ in range(rng.randint(1, 18))]
        rows = [{"conv": 1, "turn": i, "initial": r[:1], "fault": 0, "_no": i, "_block": 0}
                for i, (r, _) in enumerate(turns)]
        kinds = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        for row, fault in zip(rows, faults_of(turns)):
            row["fault"] = kinds[fault]
        cuts = sorted({0, len(turns), *(rng.randrange(len(turns)) for _ in range(4))})
        pieces = []
        for a, b in zip(cuts, cuts[1:]):
            part = [{**r, "_block": a} for r in rows[a:b]]
            pieces.append(c._piece(part, {r["_no"] for r in part}, True))
        report, parts = c._joined(pieces)
        cost, letters, left = cheapest(tuple(turns))
        assert (report["cost"], report["audit"]) == (cost, letters)
        out = []
        for (a, b), part in zip(zip(cuts, cuts[1:]), parts):
            out += c.repaired(part["letters"], turns[a:b], part["state"])
        assert tuple(out) == left


def test_linked_strings():
    rng = random.Random(1)
    tree = c.Audits()
    texts = [""]
    for _ in range(600):
        node = rng.randrange(max(0, len(texts) - 40), len(texts))
        piece = "".join(rng.choice("DK") for _ in range(rng.randint(1, 3)))
        tree.add(node, piece)
        texts.append(texts[node] + piece)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert tree.less(a, b) == (texts[a] < texts[b])


def test_one_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(7, i, rng.choice(ROLES[:5]), rng.choice(TEXTS) or f"{i}.", "", 0, 0) for i in range(600)]
    rows += [(8, 1, "user", "Same.", "", 0, 0)] * 300
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expect = brute(df.collect())
    reports, turns = c.repair(df)
    got = {r.conv: (r.cost, r.audit) for r in reports.collect()}
    assert got == {k: v[5:7] for k, v in expect.items()}
    assert {r.conv: r.sha256 for r in c.digests(turns).collect()} == {k: v[7] for k, v in expect.items()}
    assert max(len(r.turns) for r in turns.collect()) <= 3 * 16


def test_long_texts_and_nothing(spark):
    rows = [(1, 0, "user", "w " * 200_000 + ".", "", 0, 0), (1, 1, "assistant", "ok.", "", 0, 0)]
    reports, turns = c.repair(spark.createDataFrame(rows, SCHEMA))
    assert [(r.cost, r.audit) for r in reports.collect()] == [(0, "KK")]
    reports, turns = c.repair(spark.createDataFrame([], SCHEMA))
    assert reports.count() == turns.count() == c.digests(turns).count() == 0


def test_damage(spark):
    rows = [(i, t, None if i == 3 else "system", "A. b! c?" if t else None, "", 0, 0)
            for i in (*range(60), None) for t in (0, 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    import zlib
    expect = []
    for i, t, role, text, *_ in rows:
        k = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        expect += [(i, t, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    got = [tuple(r) for r in damaged_turns(df).collect()]
    assert sorted(got, key=str) == sorted(expect, key=str)

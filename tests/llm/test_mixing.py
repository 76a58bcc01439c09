import math
from collections import Counter, defaultdict

import pytest

from parcelight.llm import mixing

from .conftest import SCHEMA, row


def _brute_force(sizes, weights, block):
    """Slot of every (source, block): each frame scheduled on its own, slot by slot."""
    left = {s: -(-n // block) for s, n in sizes.items()}
    done = dict.fromkeys(left, 0)
    slots, now = {}, 0
    while any(left.values()):
        frame = {s: min(weights[s], n) for s, n in left.items() if n}
        length = sum(frame.values())
        at = dict.fromkeys(frame, 0)
        for t in range(length):
            ready = [(math.ceil((at[s] + 1) * length / m), s) for s, m in frame.items()
                     if at[s] < m and at[s] * length // m <= t]
            chosen = min(ready)[1]
            slots[chosen, done[chosen]] = now + t
            done[chosen] += 1
            at[chosen] += 1
        for s, m in frame.items():
            left[s] -= m
        now += length
    return slots


@pytest.mark.parametrize("block", [1, 4])
def test_slots_equal_brute_force(spark, block):
    sizes = {"a": 61, "b": 20, "c": 33, "d": 1, "\u0000": 9}
    weights = {"a": 5, "b": 1, "c": 2, "d": 3, "\u0000": 1}
    ids = iter(range(1000))
    rows = [row(next(ids), "x", source=None if s == "\u0000" else s)
            for s, n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = mixing.mix(docs, weights, block_rows=block).collect()
    expect = _brute_force(sizes, weights, block)
    assert len(out) == len(rows)
    for r in out:
        assert r.slot == expect[r.source or "\u0000", r.block]
        assert r.release <= r.slot < r.deadline
    assert len({r.mix_order for r in out}) == len(rows)
    for s in sizes:
        own = [r.doc_id for r in sorted(out, key=lambda r: r.mix_order)
               if (r.source or "\u0000") == s]
        assert own == sorted(own)


def test_no_source_is_a_block_off_its_target(spark):
    """While no source has run out, against the fluid share."""
    weights = {"a": 7, "b": 3, "c": 1}
    rows = [row(i, "x", source="abc"[i % 3]) for i in range(330)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights, block_rows=1).collect()
    order = [r.source for r in sorted(out, key=lambda r: r.slot)]
    seen = Counter()
    for t, source in enumerate(order[:150], 1):
        seen[source] += 1
        assert all(abs(seen[s] - t * w / 11) < 1 for s, w in weights.items())


def test_default_weights_are_roots(spark):
    rows = [row(i, "x", source="big" if i % 10 else "small") for i in range(1000)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), block_rows=1).collect()
    head = Counter(r.source for r in out if r.slot < 256)
    assert head == {"big": 192, "small": 64}


def test_odd_rows_are_all_placed(odd, nothing):
    out = mixing.mix(odd)
    rows = out.collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(
        map(str, (r.doc_id for r in odd.collect())))
    assert [c for c in out.columns if c not in mixing.ADDED] == [
        c for c in odd.columns if c not in mixing.ADDED]
    assert mixing.mix(nothing).count() == 0


def test_documents_in_mixed_order(spark, odd, nothing):
    rows = [row(i, f"t{i}", source="abc"[i % 3]) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    order = {r.doc_id: r.mix_order for r in mixing.mix(docs, block_rows=4).collect()}
    out = mixing.in_mixed_order(docs, block_rows=4)
    assert out.schema == docs.schema
    ids = [r.doc_id for r in out.collect()]
    assert ids == sorted(order, key=order.get)
    everything = mixing.in_mixed_order(odd)
    assert sorted(map(str, everything.collect())) == sorted(map(str, odd.collect()))
    assert mixing.in_mixed_order(nothing).count() == 0


def test_a_pattern_serves_many_frames(spark):
    rows = [row(i, "x", source="ab"[i % 2]) for i in range(4000)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), {"a": 3, "b": 2}, block_rows=1)
    by_slot = defaultdict(set)
    for r in out.collect():
        by_slot[r.slot].add(r.source)
    first = [by_slot[t] for t in range(5)]
    assert all([by_slot[5 * f + t] for t in range(5)] == first for f in range(500))

import random
import zlib
from collections import Counter, defaultdict

import pytest

from parcelight.llm import sharding

from .conftest import SCHEMA, row


def _best_fit(sizes, capacity):
    bins, out = [], []
    for size in sorted(sizes, reverse=True):
        fitting = [(left, i) for i, left in enumerate(bins) if left >= size]
        if fitting:
            i = min(fitting)[1]
        else:
            bins.append(max(capacity, size))
            i = len(bins) - 1
        bins[i] -= size
        out.append((size, i))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_packing_equals_best_fit(seed, monkeypatch):
    monkeypatch.setattr(sharding.CapacityTree, "LEAF", 4)
    rng = random.Random(seed)
    sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 300))]
    capacity = rng.randint(5, 200)
    packed = sharding.pack(list(Counter(sizes).items()), capacity)
    assert [(s, b) for s, n, b in packed for _ in range(n)] == _best_fit(sizes, capacity)


@pytest.mark.parametrize("seed", range(10))
def test_shards_are_nearly_equal(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 500) for _ in range(4000)] + [200_000] * (seed % 3)
    packed = sharding.pack_into(list(Counter(sizes).items()), 16)
    fill = Counter()
    for size, n, shard in packed:
        fill[shard] += size * n
    assert sum(n for _, n, _ in packed) == len(sizes) and max(fill) < 16
    alone = seed % 3  # groups beyond an equal share have a shard each
    rest = sorted(fill.values())[: 16 - alone]
    assert max(rest) - min(rest) <= 0.01 * max(rest)


def test_groups_stay_together(spark, odd):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 90))) for _ in range(200)]
    rows = [row(1000 + i, rng.choice(texts)) for i in range(600)]
    rows += [row(5000 + i, "hot text") for i in range(400)]
    docs = odd.unionByName(spark.createDataFrame(rows, SCHEMA))
    out = sharding.shard_by_bytes(docs, 7)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot"]
    expect = Counter()
    for r in docs.collect():
        data = (r.text or "").encode()
        expect[r.doc_id, len(data) + 16, zlib.crc32(data)] += 1
    slots, homes, seen = defaultdict(list), {}, Counter()
    for r in out.collect():
        seen[r.doc_id, r.size, r.text_crc32] += 1
        slots[r.shard].append(r.slot)
        assert homes.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert seen == expect and set(slots) <= set(range(7))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_any_partitioning_gives_the_same_shards(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame([row(i, "x" * rng.randint(0, 40)) for i in range(300)], SCHEMA)
    one = sorted(sharding.shard_by_bytes(docs.coalesce(1), 5).collect())
    assert one == sorted(sharding.shard_by_bytes(docs.repartition(9), 5).collect())


def test_few_groups_and_none(spark, nothing):
    docs = spark.createDataFrame([row(1, "a"), row(2, "b")], SCHEMA)
    assert len({r.shard for r in sharding.shard_by_bytes(docs, 40).collect()}) == 2
    assert sharding.shard_by_bytes(nothing, 40).count() == 0

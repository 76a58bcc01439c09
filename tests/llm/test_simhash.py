import numpy as np
import pytest
import xxhash

from parcelight.llm import simhash


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _labels(codes, radius=3):
    codes = np.asarray(codes, dtype=np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
    label = codes.copy()
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def _clustered(rng, centres=20, members=15, flips=4):
    base = rng.integers(0, 1 << 63, centres, dtype=np.uint64)
    out = [b ^ np.uint64(sum(1 << int(k) for k in set(rng.integers(0, 64, rng.integers(0, flips)))))
           for b in base for _ in range(members)]
    return np.unique(np.array(out, dtype=np.uint64))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_groups_of_any_size(radius):
    rng = np.random.default_rng(radius)
    codes = rng.permutation(_clustered(rng))
    assert len(codes) > 64
    assert (codes[simhash.large_group_roots(codes, radius)] == _labels(codes, radius)).all()
    small = np.sort(codes[:60])
    group = np.arange(60) // 17
    roots = simhash.small_group_roots(small, group, radius)
    for g in range(4):
        own = group == g
        assert (small[roots[own]] == _labels(small[own], radius)).all()


@pytest.mark.parametrize("sub_block", [4096, 16])
def test_links_give_every_component(spark, sub_block):
    rng = np.random.default_rng(7)
    codes = _clustered(rng, 12, 40, 6)  # dense: many members to a bucket
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code bigint")
    found = simhash.components(simhash.links(df.repartition(5), sub_block)).collect()
    root = {r.node: r.root for r in found}
    groups, mine = {}, {}
    for c, label in zip(codes.view(np.int64), _labels(codes)):
        groups.setdefault(int(label), set()).add(int(c))
        mine.setdefault(root.get(int(c), int(c)), set()).add(int(c))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_a_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u bigint, v bigint")
    found = simhash.components(edges.repartition(5)).collect()
    assert {r.root for r in found} == {0} and len(found) == 300


def test_rows(odd):
    rows = odd.collect()
    codes = {r.text: _fingerprint(r.text) for r in rows}
    distinct = sorted(set(codes.values()))
    label = dict(zip(distinct, _labels(distinct).tolist()))
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == len(rows)
    first = {}
    for r in rows:
        if r.doc_id is not None:
            key = label[codes[r.text]]
            first[key] = min(first.get(key, r.doc_id), r.doc_id)
    expect = sorted(str((r.doc_id, f"{codes[r.text]:016x}", first.get(label[codes[r.text]])))
                    for r in rows)
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in out) == expect


def test_one_row_of_a_component_stays(odd):
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    components = {(r.component_id, r.fingerprint if r.component_id is None else "")
                  for r in simhash.near_duplicates(odd).collect()}
    rows = kept.collect()
    assert len(rows) == len(components)
    assert {r.doc_id for r in rows if r.doc_id is not None} == {
        c for c, _ in components if c is not None}
    assert {r.fingerprint for r in rows} == {"x"}  # a column of that name is the user's


def test_no_rows(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_first(nothing).count() == 0

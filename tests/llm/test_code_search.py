import numpy as np
import pytest

from parcelight.llm import code_search

SCHEMA = "vec_id bigint, embedding array<float>, distance int, rank int, _rb int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)


def _brute_force(vectors, queries, k, width):
    def bits(v):
        v = list(v) + [0.0] * (width - len(v))
        return np.array([x is not None and x > 0 for x in v])

    codes = [(i, bits(v)) for i, v in vectors if v is not None and i is not None]
    out = set()
    for q, v in queries:
        if v is not None and q is not None:
            near = sorted((int((c != bits(v)).sum()), i) for i, c in codes)[:k]
            out |= {(q, r, i, d) for r, (d, i) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("blocks", [(16_384, 4096), (37, 3)])
@pytest.mark.parametrize("width", [64, 20, 40])
def test_equals_brute_force(spark, blocks, width):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(8, width))
    vectors = [(i, (base[i % 8] + 0.6 * rng.normal(size=width)).round(3).tolist()) for i in range(300)]
    vectors += [(400 + i, base[0].round(3).tolist()) for i in range(40)]  # one very common code
    queries = [v for v in vectors if v[0] % 50 == 0]
    got = code_search.search(_frame(spark, vectors), _frame(spark, queries), 10,
                             block_rows=blocks[0], block_queries=blocks[1]).collect()
    assert {(r.query_id, r["rank"], r.id, r.distance) for r in got} == _brute_force(
        vectors, queries, 10, width)


def test_a_radius_covers_before_the_search_ends():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (500, 4)).astype(np.uint16)
    index = code_search.MultiIndex(codes, np.arange(500))
    for code in rng.integers(0, 1 << 16, (20, 4)).astype(np.uint16):
        distance = np.bitwise_count(codes ^ code).sum(axis=1)
        order = np.lexsort((np.arange(500), distance))[:5]
        rows, found = index.nearest(code, 5)
        assert rows.tolist() == order.tolist() and found.tolist() == distance[order].tolist()


def test_odd_vectors(spark):
    nan = float("nan")
    vectors = [(1, [1.0, -1.0, nan]), (2, None), (3, []), (4, [1.0, None, 1.0]), (5, [0.0, 0.0, 0.0]),
               (None, [1.0, 1.0, 1.0]), (1, [1.0, -1.0, nan])]
    df = _frame(spark, vectors)
    clean = [(i, None if v is None else [0.0 if x is None or x != x else x for x in v])
             for i, v in vectors]
    got = code_search.search(df, df.where("vec_id IN (1, 2, 5)"), 10).collect()
    rows = {(r.query_id, r["rank"], r.id, r.distance) for r in got}
    assert rows == _brute_force(clean, [c for c in clean if c[0] in (1, 5)], 10, 3)
    none = df.where("false")
    assert code_search.search(none, none).count() == 0
    assert code_search.search(df, none).count() == 0


def test_queries_that_repeat_are_rows_of_their_own(spark):
    vectors = [(0, [1.0, 1.0, 1.0]), (1, [-1.0, -1.0, -1.0]), (50, [1.0, 1.0, 1.0]),
               (50, [-1.0, -1.0, -1.0]), (100, [1.0, -1.0, 1.0]), (100, [1.0, -1.0, 1.0])]
    df = _frame(spark, vectors)
    asked = [v for v in vectors if v[0] in (50, 100)]
    got = code_search.search(df, df.where("vec_id IN (50, 100)"), 3, block_rows=2, block_queries=1)
    rows = sorted((r.query_id, r["rank"], r.id, r.distance) for r in got.collect())
    # Each asked row has a whole list.
    assert rows == sorted(r for q in asked for r in _brute_force(vectors, [q], 3, 3))
    assert len(rows) == 12

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelight.operators import (
    attach_group_values,
    exact_quantiles,
    first_by_key,
    number_rows,
    quantiles,
    RANK_ERROR,
    require_columns,
    sketch_quantiles,
    top_counts,
    value_sketch,
)
from parcelight.operators.quantiles import ordered_bits


@pytest.mark.parametrize("partitions", [1, 16])
def test_numbers_are_dense_and_in_order(spark, partitions):
    # A third of all rows ties on the leading column.
    df = (
        spark.range(3000)
        .withColumn("score", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(7)))
        .repartition(partitions)
    )
    order = [F.desc("score"), F.asc("id")]
    # rand() is fixed by writing it before use
    rows = [(r.id, r.score) for r in df.collect()]
    fixed = spark.createDataFrame(rows, "id bigint, score double").repartition(partitions)
    out = number_rows(fixed, order, "rank").collect()
    expect = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r.id for r in sorted(out, key=lambda r: r["rank"])] == [i for i, _ in expect]
    assert sorted(r["rank"] for r in out) == list(range(1, 3001))


def test_numbers_start_where_asked_and_accept_nothing(spark):
    out = number_rows(spark.range(3), [F.col("id")], "n", start=11)
    assert sorted(r.n for r in out.collect()) == [11, 12, 13]
    assert number_rows(spark.range(0), [F.col("id")], "n").count() == 0


def _numpy_quantiles(values, probs):
    return [float(np.quantile(values, p)) for p in probs]


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([
        rng.lognormal(11, 2, 400), -rng.lognormal(3, 3, 200), np.zeros(50),
        np.full(300, 1234.5), rng.uniform(-1e-9, 1e-9, 50),
    ])
    odd = [(None,), (float("nan"),), (float("inf"),), (float("-inf"),)]
    df = spark.createDataFrame([(float(v),) for v in values] + odd, "v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    row = exact_quantiles(df, "v", {f"q{i}": p for i, p in enumerate(probs)}).first()
    assert list(row) == pytest.approx(_numpy_quantiles(values, probs), rel=1e-12, abs=1e-15)


def test_quantiles_by_group(spark):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.integers(1900, 2020, 900), "one": np.array([1950]),
              "two": np.array([1990, 1999])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [(None, 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    out = {r.g: (r.m, r.q) for r in exact_quantiles(df, "v", {"m": 0.5, "q": 0.25}, ["g"]).collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        assert list(out[g]) == pytest.approx(_numpy_quantiles(vs, [0.5, 0.25]))


EDGES = [0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, -1e-310, 1.7976931348623157e308,
         -1.7976931348623157e308, 1.0, 1.0000000000000002, 0.9999999999999999, -1.0, 3.5, 1e17]


def test_ordered_bits_keep_the_order(spark):
    rng = np.random.default_rng(5)
    values = sorted({*EDGES, *(float(v) for v in rng.standard_cauchy(500))})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bits = [r.b for r in df.select("v", ordered_bits(F.col("v")).alias("b")).orderBy("v").collect()]
    assert bits == sorted(set(bits))


@pytest.mark.parametrize("few", [1, 7])
def test_quantiles_by_radix_selection(spark, few, monkeypatch):
    """Values that agree in all but their last bits need every level."""
    monkeypatch.setattr(quantiles, "_FEW", few)
    rng = np.random.default_rng(few)
    near = 1e6 + np.arange(200) * 2.0 ** -33
    groups = {
        "near": np.repeat(near, rng.integers(1, 4, near.size)),
        "edges": np.array(EDGES[:5] * 3 + [1.0, 3.5]),
        "wide": np.concatenate([rng.standard_cauchy(400) * 10.0 ** rng.integers(-8, 9, 400), np.zeros(150)]),
        "one": np.array([-2.5] * 90),
    }
    df = spark.createDataFrame(
        [(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double"
    ).repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.51, 0.9, 1.0]
    out = exact_quantiles(df, "v", {f"q{i}": p for i, p in enumerate(probs)}, ["g"]).collect()
    assert {r.g for r in out} == set(groups)
    for r in out:
        assert list(r)[1:] == pytest.approx(_numpy_quantiles(groups[r.g], probs), rel=1e-14, abs=1e-320)
    row = exact_quantiles(df, "v", {"m": 0.5}).first()
    assert row["m"] == pytest.approx(float(np.quantile(np.concatenate([*groups.values()]), 0.5)))


def _nodes(df, *names):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [plan.count(n) for n in names]


def test_quantiles_read_their_input_once_and_then_its_counts(spark, tmp_path):
    spark.range(5000).selectExpr("id % 7 AS g", "id * 0.5 AS v").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    out = exact_quantiles(df, "v", {"a": 0.25, "b": 0.75}, ["g"])
    assert _nodes(out, "FileScan", "Exchange") == [1, 1]  # the stored counts, dealt by group


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first()["m"] is None


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_attached_values_with_a_hot_key(spark, threshold):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k string")
    groups = df.where("k is not null").groupBy("k").agg(F.avg("id").alias("mean"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = {r.id: (r.k, r["mean"]) for r in attach_group_values(df, groups, "k").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    hot = [i for i, k in rows if k == "hot"]
    assert len(out) == 300
    for i, k in rows:
        expect = sum(hot) / len(hot) if k == "hot" else float(i) if k else None
        assert out[i] == (k, pytest.approx(expect) if k else None)


def test_first_by_key_uses_the_order_and_keeps_nulls(spark):
    rows = [("a", 2, "late"), ("a", 1, None), (None, 5, "x"), (None, 4, "first")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(4)
    out = first_by_key(df, "k", ["v"], F.col("o")).collect()
    assert {(r.k, r.v) for r in out} == {("a", None), (None, "first")}


def test_top_counts_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"] + [(None,)], "v string")
    assert [(r.value, r.n) for r in top_counts(df, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_require_columns_names_the_missing(spark):
    with pytest.raises(ValueError, match="b"):
        require_columns(spark.range(1), ["id", "b"], "table")


def _heavy(n):
    """A third of the rows has one value; the rest is skewed."""
    return F.when(F.col("id") % 3 == 0, 500.0).otherwise(
        F.pow(F.pmod(F.xxhash64("id"), F.lit(n)).cast("double"), 2.0))


@pytest.mark.parametrize("loads", [1, 7])
def test_sketched_quantiles_are_within_their_rank_error(spark, loads):
    rows = spark.range(300_000).select("id", _heavy(100_000).alias("v"))
    sketches = None
    for load in range(loads):  # as stored by one load after the other
        one = value_sketch(rows.where(F.col("id") % loads == load), "v")
        sketches = one if sketches is None else sketches.union(one)
    wanted = {f"p{p}": p / 100 for p in (1, 25, 50, 75, 99)}
    found = sketch_quantiles(sketches, wanted).first().asDict()
    values = np.sort([r.v for r in rows.select("v").collect()])
    for name, p in wanted.items():
        below = np.searchsorted(values, found[name], "left") / len(values)
        upto = np.searchsorted(values, found[name], "right") / len(values)
        assert below - RANK_ERROR <= p <= upto + RANK_ERROR
    assert 0 < RANK_ERROR < 0.001
    assert max(len(r.sketch) for r in sketches.collect()) < 200_000


def test_sketches_of_few_or_no_values(spark):
    rows = spark.createDataFrame(
        [(1.0,), (2.0,), (9.0,), (None,), (float("nan"),), (float("inf"),)], "v double")
    nothing = value_sketch(rows.where("v IS NULL"), "v")
    both = value_sketch(rows, "v").union(nothing)
    assert sketch_quantiles(both, {"low": 0.0, "mid": 0.5, "top": 1.0}).first() == (1.0, 2.0, 9.0)
    assert sketch_quantiles(nothing, {"mid": 0.5}).first() == (None,)
    assert sketch_quantiles(both.limit(0), {"mid": 0.5}).first() == (None,)

from pyspark.sql import functions as F

from parcelight import functions as X
from parcelight.constants import NA_TOKENS


def _values(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_parse_number(spark):
    good = {"12": 12.0, " 12.5 ": 12.5, "-3": -3.0, "+.5": 0.5, "7.": 7.0, "1e3": 1000.0}
    assert _values(spark, list(good), X.parse_number) == list(good.values())
    bad = ["", "abc", "1.5d", "2F", "1_000", "0x10", "0x1p3", "inf", "-Infinity", "nan",
           "1,000", "1 2", "--1", None, "1e999"]
    assert _values(spark, bad, X.parse_number) == [None] * len(bad)
    assert _values(spark, ["x", None, "4"], X.number_or_zero) == [0.0, 0.0, 4.0]


def test_numbers_are_parsed_without_rebuilding_the_text(spark):
    df = spark.createDataFrame([("1",)], "t string")
    plan = df.select(X.number_or_zero("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan.lower()
    letters = ["1d", "1D", "1f", "1F", " 1d ", "0x1P3", "0X1p3", "d", "1e5F", "-2.5D"]
    assert _values(spark, letters, X.parse_number) == [None] * len(letters)


def test_missing_tokens_match_whole_text_only(spark):
    assert _values(spark, list(NA_TOKENS), X.missing_to_null) == [None] * len(NA_TOKENS)
    kept = [" NA", "NAN", "none", "0", "null "]
    assert _values(spark, kept, X.missing_to_null) == kept


def test_normal_text(spark):
    texts = ["  a b\t", None, " x　", ""]
    assert _values(spark, texts, X.normal_text) == ["a b", "nan", "x", ""]
    upper = _values(spark, texts, lambda c: X.normal_text(c, True, strict_nulls=True))
    assert upper == ["A B", None, "X", ""]


def test_zero_pad_keeps_longer_text(spark):
    assert _values(spark, ["1", "10", "001", "1234", ""], lambda c: X.zero_pad(c, 3)) == [
        "001", "010", "001", "1234", "000"]


def test_prefixes(spark):
    assert _values(spark, [" 00100", None, "1"], X.code_prefix) == ["001", "nan", "1"]
    assert _values(spark, ["32601-1234", "bad", None, "326"], X.zip5) == [
        32601.0, 0.0, 0.0, 326.0]
    assert _values(spark, ["2019-05-01", "05/01/2019", None], X.year_prefix) == [
        2019.0, 0.0, 0.0]


def test_value_tier_edges_are_right_closed(spark):
    values = [None, -1.0, 0.0, 0.01, 50000.0, 50000.01, 150000.0, 300000.0, 500000.0, 500000.01]
    assert _values(spark, values, X.value_tier, "double") == [
        None, None, None, "distressed", "distressed", "entry", "entry", "mid", "upper",
        "premium"]
    assert _values(spark, values, X.value_tier_code, "double") == [
        0, 0, 0, 0, 0, 1, 1, 2, 3, 4]


def test_temperature_edges(spark):
    assert _values(spark, [0.8, 0.79999, 0.5, 0.49999, None], X.temperature, "double") == [
        "HOT", "WARM", "WARM", "COLD", "COLD"]


def test_ratio_without_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(X.ratio("a", "b")).collect()] == [None, None, 2.0]


def test_hash_spreads_sequential_ids(spark):
    ids = spark.range(1, 100_001)
    row = ids.select(
        F.avg(X.is_test_row("id", 0.2, 42).cast("double")).alias("test"),
        F.min(X.fold_of("id", 5, 42)).alias("low"),
        F.max(X.fold_of("id", 5, 42)).alias("high"),
    ).first()
    assert abs(row["test"] - 0.2) < 0.002
    assert (row["low"], row["high"]) == (1, 5)
    sizes = ids.groupBy(X.fold_of("id", 5, 42)).count().collect()
    assert all(abs(r["count"] - 20_000) < 100 for r in sizes)
    huge = spark.createDataFrame([(2**62,)], "id bigint")
    assert 0 <= huge.select(X.spread_hash("id", 42)).first()[0] < 2**32

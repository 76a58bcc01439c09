import pytest
from pyspark.sql import functions as F

from parcelight.functions import signal_score
from parcelight.plans import features as fe

BASE = dict(OBJECTID=1, OWN_NAME="ANN", OWN_STATE_="FL", JV=200000.0, JV_HMSTD=50000.0,
            LND_VAL=1.0, LND_SQFOOT=100.0, TOT_LVG_AR=50.0, ACT_YR_BLT=2010, EFF_YR_BLT=2015,
            SALE_PRC1=1.0, SALE_YR1=2000.0, QUAL_CD1="Q-QUALIFIED", NBRHD_CD="1",
            NO_BULDNG=1.0)
SCHEMA = ("OBJECTID bigint, OWN_NAME string, OWN_STATE_ string, JV double, JV_HMSTD double, "
          "LND_VAL double, LND_SQFOOT double, TOT_LVG_AR double, ACT_YR_BLT int, "
          "EFF_YR_BLT int, SALE_PRC1 double, SALE_YR1 double, QUAL_CD1 string, "
          "NBRHD_CD string, NO_BULDNG double")


def _frame(spark, *changes):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    rows = [{**BASE, "OBJECTID": i, **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def _column(df, *columns):
    rows = df.orderBy("OBJECTID").select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in rows]


def test_flags(spark):
    names = _frame(spark, *[{"OWN_NAME": n} for n in
                            ["Vincent", "smith llc", "A Trust B", "ANN", "", None]])
    assert _column(names, fe.corporate_owner()) == [1, 1, 1, 0, 0, 0]
    states = _frame(spark, *[{"OWN_STATE_": s} for s in [" FL ", "GA", "", "nan", "fl", None]])
    assert _column(states, fe.out_of_state_owner()) == [0, 1, 0, 1, 1, 0]
    assert _column(states, fe.out_of_state_owner(strict_nulls=True)) == [0, 1, 0, 0, 1, 0]
    codes = _frame(spark, *[{"QUAL_CD1": c} for c in [" u-x", "U", "Q-U", "", None]])
    assert _column(codes, fe.distressed_sale()) == [1, 1, 0, 0, 0]
    exempt = _frame(spark, {"JV_HMSTD": 0.0}, {"JV_HMSTD": 1.0}, {"JV_HMSTD": None})
    assert _column(exempt, fe.absentee_owner()) == [1, 0, 0]
    price = _frame(spark, {"SALE_PRC1": 0.0}, {"SALE_PRC1": 2.0})
    assert _column(price, fe.never_sold()) == [1, 0]


def test_numbers(spark):
    df = _frame(spark, {}, {"TOT_LVG_AR": None}, {"LND_SQFOOT": 0.0}, {"JV": 0.0, "ACT_YR_BLT": 2030})
    assert _column(df, fe.property_age(2025)) == [15, 15, 15, 0]
    assert _column(df, fe.price_per_sqft()) == [4000.0, 0.0, 4000.0, 0.0]
    assert _column(df, fe.lot_coverage()) == [0.5, 0.0, 0.0, 0.5]
    assert _column(df, fe.renovation_gap()) == [5, 5, 5, -15]
    assert _column(df, fe.land_ratio()) == [1 / 200000, 1 / 200000, 1 / 200000, 1.0]


def test_neighborhood_ratio(spark):
    df = _frame(spark, {"JV": 100.0}, {"JV": 300.0}, {"NBRHD_CD": None}, {"NBRHD_CD": "nan", "JV": 7.0},
                {"NBRHD_CD": "0", "JV": 0.0})
    out = fe.with_neighborhood_ratio(df)
    assert _column(out, "neighborhood_value_ratio") == [0.5, 1.5, 1.0, 1.0, 1.0]


def test_label_needs_three_signals(spark):
    signals = [dict(SALE_PRC1=0.0), dict(JV_HMSTD=0.0), dict(OWN_STATE_="GA"),
               dict(ACT_YR_BLT=1994), dict(JV=150000.0, NBRHD_CD="own"), dict(QUAL_CD1="U")]
    changes, merged = [{}], {}
    for s in signals:
        merged = {**merged, **s}
        changes.append(dict(merged))
    df = _frame(spark, *[{**c, "NBRHD_CD": f"own{i}"} for i, c in enumerate(changes)])
    out = fe.add_features(df, 2025)
    assert _column(out, signal_score(), "hot_lead") == [
        (0, 0), (1, 0), (2, 0), (3, 1), (4, 1), (5, 1), (6, 1)]
    for row in out.collect():
        assert row["hot_lead"] == int(out.where(F.col("OBJECTID") == row["OBJECTID"])
                                      .select(signal_score()).first()[0] >= 3)


def test_age_signal_is_strict(spark):
    df = fe.add_features(_frame(spark, {"ACT_YR_BLT": 1995}, {"ACT_YR_BLT": 1994}), 2025)
    assert _column(df, signal_score()) == [0, 1]


def test_model_columns_are_filled_after_the_ratios(spark):
    out = fe.engineer(_frame(spark, {"TOT_LVG_AR": None}), 2025).first()
    assert out["TOT_LVG_AR"] == 0.0 and out["price_per_sqft"] == 0.0
    with pytest.raises(ValueError, match="NO_BULDNG"):
        fe.fill_model_columns(fe.add_features(_frame(spark, {}), 2025).drop("NO_BULDNG"))

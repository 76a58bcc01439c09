import random

import pytest

from parcelight.constants import LEAD_COLUMNS, SOURCE_COLUMNS
from parcelight.plans import ingest


def _table(spark, name, rows):
    columns = SOURCE_COLUMNS[name]
    schema = ", ".join(f"{c} string" for c in columns) + ", _ord int"
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)], schema
    ).repartition(3)


@pytest.fixture
def sources(spark):
    return {
        "property": _table(spark, "property", [
            ("P1", " Archer ", " 10 ", "00100"),
            ("P1", "SECOND", "99", "00900"),       # repeated parcel: first row stays
            ("P2", None, None, "00200"),
            (None, "LaCrosse", "11", "00700"),     # missing parcel joins missing parcel
            ("P3", "NEWBERRY", "12", "00400"),
        ]),
        "owners": _table(spark, "owners", [
            ("P1", "ann llc", "1 A St", "FL", "32601-1234"),
            ("P1", "bob", "2 B St", "GA", "32602"),
            ("P2", None, None, None, "bad"),
            (None, "nobody", "3 C St", " GA", "32640"),
        ]),
        "history": _table(spark, "history", [
            ("P1", "2019", "100", "10", "1"),
            ("P1", "2021", "300", "30", "0"),
            ("P1", "2021", "400", "40", "5"),      # same year: first in the file
            ("P1", "n/k", "900", "90", "9"),       # unreadable year: last
            ("P2", "n/k", "1.5d", "7", None),
            (None, "2020", "50000", "5", "0"),
        ]),
        "land": _table(spark, "land", [
            ("P1", "100"), ("P1", "x"), ("P1", "50.5"), (None, "7"), ("P2", None),
        ]),
        "improvements": _table(spark, "improvements", [
            ("P1", "SFR", "1990", "2000", "1500", "1"),
            ("P1", "SFR", "1980", "1985", "1500", "2"),   # tie on area: first
            ("P1", " SOHM ", "1900", "1900", "9000", "3"),
            ("P1", None, "1970", "1971", "10", None),
            ("P2", "NSOHM", "1990", "2000", "1500", "1"),
            (None, "SFR", "1990", "2000", "1500", "1"),
        ]),
        "sales": _table(spark, "sales", [
            ("P1", "1", "2001-01-01", "50", "Q-QUALIFIED"),
            ("P1", "0", "2010-01-01", "90", None),
            ("P1", "0", "2011-01-01", "91", "U-UNQUALIFIED"),
            ("P2", "1", "2002-02-02", "60", "Q-QUALIFIED"),  # no line 0: not sold
            (None, "0.0", None, "bad", "U"),
        ]),
    }


def _rows(df):
    return {r["Parcel"]: r.asDict() for r in df.collect()}


def test_property_and_owner_first_rows(sources):
    prop = _rows(ingest.prepare_property(sources["property"]))
    assert prop["P1"] == {"Parcel": "P1", "DOR_UC": "001", "PHY_CITY": "ARCHER", "NBRHD_CD": "10"}
    assert prop["P2"]["PHY_CITY"] == "NAN" and prop["P2"]["NBRHD_CD"] == "nan"
    assert set(prop) == {"P1", "P2", "P3", None}
    own = _rows(ingest.prepare_owners(sources["owners"]))
    assert own["P1"]["OWN_NAME"] == "ann llc" and own["P1"]["PHY_ZIPCD"] == 32601.0
    assert own["P2"] == {"Parcel": "P2", "OWN_NAME": "nan", "OWN_ADDR1": "nan",
                         "OWN_STATE_": "nan", "PHY_ZIPCD": 0.0}
    strict = _rows(ingest.prepare_owners(sources["owners"], strict_nulls=True))
    assert strict["P2"]["OWN_STATE_"] is None


def test_history_latest_year(sources):
    hist = _rows(ingest.prepare_history(sources["history"]))
    assert hist["P1"]["JV"] == 300.0 and hist["P1"]["JV_HMSTD"] == 0.0
    assert hist["P2"]["JV"] == 0.0 and hist["P2"]["LND_VAL"] == 7.0
    assert hist[None]["JV"] == 50000.0


def test_land_improvements_and_sales(sources):
    assert _rows(ingest.prepare_land(sources["land"])) == {
        "P1": {"Parcel": "P1", "LND_SQFOOT": 150.5}, "P2": {"Parcel": "P2", "LND_SQFOOT": 0.0}}
    imprv = _rows(ingest.prepare_improvements(sources["improvements"]))
    assert set(imprv) == {"P1"}
    assert imprv["P1"] == {"Parcel": "P1", "ACT_YR_BLT": 1990.0, "EFF_YR_BLT": 2000.0,
                           "TOT_LVG_AR": 1500.0, "NO_BULDNG": 2, "NO_RES_UNT": 2}
    sold = _rows(ingest.prepare_sales(sources["sales"]))
    assert set(sold) == {"P1", None}
    assert sold["P1"] == {"Parcel": "P1", "SALE_PRC1": 90.0, "SALE_YR1": 2010.0, "QUAL_CD1": "",
                          "SALE_PRC2": 50.0, "SALE_YR2": 2001.0}


def test_leads(sources):
    leads = ingest.build_leads(sources)
    assert leads.columns == LEAD_COLUMNS
    rows = _rows(leads)
    assert [rows[p]["OBJECTID"] for p in ("P1", "P2", None, "P3")] == [1, 2, 3, 4]
    assert rows[None]["OWN_NAME"] == "nobody" and rows[None]["JV"] == 50000.0
    assert rows[None]["LND_SQFOOT"] == 0.0  # sums leave missing parcels out
    assert rows["P3"]["OWN_STATE_"] == "" and rows["P3"]["JV"] == 0.0
    assert rows["P1"]["PHY_ADDR1"] == rows["P1"]["OWN_ADDR1"] == "1 A St"
    types = dict(leads.dtypes)
    assert types["NO_BULDNG"] == "double" and types["OBJECTID"] == "bigint"


def test_leads_do_not_depend_on_partitioning(sources):
    whole = {n: df.coalesce(1) for n, df in sources.items()}
    split = {n: df.repartition(9) for n, df in sources.items()}
    left, right = ingest.build_leads(whole).collect(), ingest.build_leads(split).collect()
    assert sorted(map(str, left)) == sorted(map(str, right))


def test_resume_slice_and_layout(sources):
    leads = ingest.build_leads(sources)
    ids = lambda df: sorted(r.OBJECTID for r in df.collect())
    assert ids(ingest.resume_slice(leads, 1, 3)) == [2, 3]
    assert ids(ingest.resume_slice(leads, 2, None)) == [3, 4]
    assert ids(ingest.resume_slice(leads, 2, 100)) == [3, 4]
    with pytest.raises(ValueError, match="JV"):
        ingest.select_lead_columns(leads.drop("JV"))


def test_improvements_compare_one_struct_and_strip_few_types(spark):
    kinds = ["SOHM", " NSOHM\u00a0", "xSOHM", "SOHM x", "", None, "sohm", "SO HM", "\u2003SOHM\t"]
    rows = [("P", k, "0", "0", "1", str(i)) for i, k in enumerate(kinds)]
    # Equal areas, the last of them written another way: the first row wins.
    rows += [("Q", "A", y, e, a, "1") for y, e, a in
             [(None, "7", "50"), ("1", None, "50.0"), ("0", "1", " 5e1 "), ("9", "9", "-0")]]
    rows += [("R", "A", "5", None, "bad", None), ("R", "A", "4", "4", None, None)]
    table = _table(spark, "improvements", rows)
    kept = ingest.drop_non_buildings(table.where("Parcel = 'P'")).collect()
    assert sorted(r.Bldg_Num for r in kept) == ["2", "3", "4", "5", "6", "7"]
    found = ingest.prepare_improvements(table)
    out = {r.Parcel: r for r in found.collect()}
    best = lambda r: (r.ACT_YR_BLT, r.EFF_YR_BLT, r.TOT_LVG_AR, r.NO_BULDNG)
    assert best(out["Q"]) == (0.0, 7.0, 50.0, 1) and best(out["R"]) == (5.0, 0.0, 0.0, 0)
    assert str(out["R"].TOT_LVG_AR) == "0.0" and out["P"].NO_BULDNG == 6
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan and "Contains" in plan


def test_joins_add_no_shuffle(spark, sources):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ingest.build_leads(sources, numbered=False)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    # One per source, and one more to count distinct buildings. The fixture's
    # own repartitioning is the other six.
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("SortMergeJoin") == 5


def test_one_parcel_may_hold_a_third_of_every_table(spark):
    """Against plain Python, with a hot parcel and repeated, shuffled rows."""
    rng = random.Random(11)

    def key():
        return "HOT" if rng.random() < 1 / 3 else rng.choice([None, "A", "B", "C", "D"])

    def text(low, high):
        return rng.choice([str(rng.randint(low, high)), "bad", None, f"{rng.uniform(low, high):.2f}"])

    size = 600
    data = {
        "property": [(key(), "X", "1", "00100") for _ in range(size)],
        "owners": [(key(), text(0, 9), "a", "FL", "32601") for _ in range(size)],
        "history": [(key(), text(2000, 2004), text(1, 9), "1", "0") for _ in range(size)],
        "land": [(key(), text(1, 50)) for _ in range(size)],
        "improvements": [(key(), rng.choice(["SFR", "SOHM", None]), text(1900, 2000), "0",
                          text(1, 20), rng.choice(["1", "2", None])) for _ in range(size)],
        "sales": [(key(), rng.choice(["0", "1", "2", "x"]), text(1990, 2020), text(0, 90), "U")
                  for _ in range(size)],
    }

    def number(t):
        try:
            return float(t)
        except (TypeError, ValueError):
            return None

    def zero(t):
        return number(t) or 0.0

    leads = _rows(ingest.build_leads({n: _table(spark, n, rows) for n, rows in data.items()}))
    order = list(dict.fromkeys(r[0] for r in data["property"]))
    assert [p for p, _ in sorted(leads.items(), key=lambda t: t[1]["OBJECTID"])] == order
    for parcel, lead in leads.items():
        mine = {n: [r for r in rows if r[0] == parcel] for n, rows in data.items()}
        years = [(-(number(r[1]) if number(r[1]) is not None else float("-inf")), i)
                 for i, r in enumerate(mine["history"])]
        assert lead["JV"] == zero(mine["history"][min(years)[1]][2])
        owner = mine["owners"][0][1]
        assert lead["OWN_NAME"] == ("nan" if owner is None else owner)
        lines = {n: [r for r in mine["sales"] if r[1] == n] for n in ("0", "1")}
        assert lead["SALE_PRC1"] == (zero(lines["0"][0][3]) if lines["0"] else 0.0)
        both = lines["0"] and lines["1"]
        assert lead["SALE_PRC2"] == (zero(lines["1"][0][3]) if both else 0.0)
        if parcel is None:
            assert lead["LND_SQFOOT"] == lead["NO_BULDNG"] == 0.0
            continue
        assert lead["LND_SQFOOT"] == pytest.approx(sum(zero(r[1]) for r in mine["land"]))
        built = [r for r in mine["improvements"] if r[1] != "SOHM"]
        largest = max(built, key=lambda r: zero(r[4]))  # first of equals
        assert (lead["TOT_LVG_AR"], lead["ACT_YR_BLT"]) == (zero(largest[4]), zero(largest[2]))
        assert lead["NO_BULDNG"] == len({r[5] for r in built} - {None})

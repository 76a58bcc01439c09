import random

import numpy as np
import pytest

from parcelight.constants import LEADS_SCHEMA
from parcelight.plans import cleaning


def _leads(spark, rows):
    schema = "OBJECTID bigint, DOR_UC string, JV double, PHY_CITY string, PHY_ZIPCD double, " \
             "ACT_YR_BLT double, EFF_YR_BLT double, TOT_LVG_AR double"
    return spark.createDataFrame(rows, schema).repartition(3)


def _by_id(df, *columns):
    return {r["OBJECTID"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_residential_codes_are_padded_first(spark):
    rows = [(i, c, 1.0, "X", 0.0, 0.0, 0.0, 0.0)
            for i, c in enumerate([" 1", "2", "007", "10", "100", "004", None, "0001"])]
    kept = _by_id(cleaning.keep_residential(_leads(spark, rows)), "DOR_UC")
    assert kept == {0: ("001",), 1: ("002",), 2: ("007",), 3: ("010",)}


def test_minimum_value_is_inclusive(spark):
    rows = [(i, "001", v, "X", 0.0, 0.0, 0.0, 0.0) for i, v in enumerate([999.99, 1000.0, 0.0])]
    assert set(_by_id(cleaning.keep_minimum_value(_leads(spark, rows)), "JV")) == {1}


def test_fence_is_fitted_on_the_filtered_rows(spark):
    rng = random.Random(5)
    values = [round(rng.lognormvariate(12, 1.2), 2) for _ in range(500)]
    rows = [(i, "001" if i % 4 else "900", v if i % 5 else 500.0, "X", 0.0, 0.0, 0.0, 0.0)
            for i, v in enumerate(values)]
    used = [r[2] for r in rows if r[1] == "001" and r[2] >= 1000]
    q1, q3 = np.quantile(used, 0.25), np.quantile(used, 0.75)
    bound = q3 + 1.5 * (q3 - q1)
    kept = cleaning.filter_leads(_leads(spark, rows))
    assert sorted(r.JV for r in kept.collect()) == sorted(v for v in used if v <= bound)
    assert len(used) > kept.count()


def test_city(spark):
    cities = [(" gainesville ", 0.0), ("LaCrosse", 0.0), ("nan", 32640.0), ("", 32694.9),
              ("", 99999.0), (None, None), ("la crosse", 32601.0)]
    rows = [(i, "001", 1.0, c, z, 0.0, 0.0, 0.0) for i, (c, z) in enumerate(cities)]
    out = cleaning.fill_city(_leads(spark, rows))
    assert _by_id(out, "PHY_CITY", "PHY_ZIPCD") == {
        0: ("GAINESVILLE", 0), 1: ("LA CROSSE", 0), 2: ("HAWTHORNE", 32640),
        3: ("WALDO", 32694), 4: ("UNKNOWN", 99999), 5: ("UNKNOWN", 0), 6: ("LA CROSSE", 32601)}
    share = cleaning.unknown_city_share(out).first()
    assert (share["records"], share["unknown"], share["warn"]) == (7, 2, True)


def test_years(spark):
    years = [("001", 1990.0, 0.0), ("001", 1991.0, 2000.0), ("001", 0.0, 0.0),
             ("002", 0.0, 1999.0), ("007", 1950.0, 0.0)]
    rows = [(i, c, 1.0, "X", 0.0, a, e, 0.0) for i, (c, a, e) in enumerate(years)]
    filled = cleaning.fill_actual_year(_leads(spark, rows))
    out = cleaning.fill_effective_year(filled)
    # 001: median 1990.5 is cut to 1990; 002 has no known year: overall median 1990.
    assert _by_id(out, "ACT_YR_BLT", "EFF_YR_BLT") == {
        0: (1990, 1990), 1: (1991, 2000), 2: (1990, 1990), 3: (1990, 1999), 4: (1950, 1950)}
    assert dict(out.dtypes)["ACT_YR_BLT"] == "int"


def test_years_of_200_codes(spark):
    rows = [(4 * c + k, f"{c:03}", 1.0, "X", 0.0, y, 0.0, 0.0)
            for c in range(200) for k, y in enumerate((1900.0 + c % 90, 1902.0 + c % 90, 0.0))]
    out = _by_id(cleaning.fill_actual_year(_leads(spark, rows)), "ACT_YR_BLT")
    assert all(out[4 * c + 2] == (1901 + c % 90,) for c in range(200))


def test_no_known_year_is_an_error(spark):
    rows = [(1, "001", 1.0, "X", 0.0, 0.0, 0.0, 0.0)]
    with pytest.raises(Exception, match="year"):
        cleaning.fill_actual_year(_leads(spark, rows)).collect()


def test_numbers_out_of_range_are_unusable(spark):
    rows = [(1, "001", 5000.0, "", 1e300, 1990.0, 1e12, 1.0),
            (2, "001", 5000.0, "X", -1e300, -1e15, 0.0, 1.0)]
    out = _by_id(cleaning.clean_leads(_leads(spark, rows)), "PHY_ZIPCD", "EFF_YR_BLT")
    assert out == {1: (0, 0), 2: (0, 0)}


def test_an_unstored_input_is_read_once_when_statistics_are_given(spark):
    rows = [(i, "001", 2000.0 + i, "X", 0.0, 1990.0 * (i % 2), 0.0, 1.0) for i in range(60)]
    df = _leads(spark, rows)
    fitted = cleaning.fit_cleaning(df)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = df.mapInArrow(count, df.schema)
    out = cleaning.clean_leads(counted, fitted)
    assert seen.value == 0  # nothing has run yet
    assert out.count() == 60 and seen.value == 60


def test_cleaning_nothing_gives_nothing(spark):
    empty = spark.createDataFrame([], LEADS_SCHEMA)
    assert cleaning.clean_leads(empty).count() == 0


def test_living_area(spark):
    rows = [(i, "001", 1.0, "X", 0.0, 0.0, 0.0, a) for i, a in enumerate([0.0, 5.0, None])]
    out = cleaning.blank_living_area(_leads(spark, rows))
    assert _by_id(out, "TOT_LVG_AR") == {0: (None,), 1: (5.0,), 2: (None,)}


def test_filters_reach_the_scan(spark, tables):
    rows = [(i, "001", 1000.0 + i, "X", 0.0, 1990.0, 0.0, 1.0) for i in range(50)]
    _leads(spark, rows).write.parquet(tables.path("leads"))
    stored = spark.read.parquet(tables.path("leads"))
    plan = cleaning.clean_leads(stored, cleaning.fit_cleaning(stored))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text
    assert "LessThanOrEqual(JV" in text

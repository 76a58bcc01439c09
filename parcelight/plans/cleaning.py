"""Filters and repairs from leads to clean leads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.constants import (
    CITY_SPELLING,
    FENCE_FACTOR,
    MIN_JUST_VALUE,
    RESIDENTIAL_CODES,
    UNKNOWN_CITY,
    UNKNOWN_CITY_LIMIT_PCT,
    ZIP_TO_CITY,
)
from parcelight.functions import normal_text, whole_number, zero_pad, zero_to_null
from parcelight.operators import exact_quantiles, sketch_quantiles, value_sketch
from parcelight.storage import materialize

# Group of all rows; no use code looks like this.
ALL_CODES = "\u0000"

_QUARTILES = {"q1": 0.25, "q3": 0.75}


def pad_use_code(df: DataFrame) -> DataFrame:
    return df.withColumn("DOR_UC", zero_pad(normal_text("DOR_UC"), 3))


def keep_residential(df: DataFrame, codes=RESIDENTIAL_CODES) -> DataFrame:
    return pad_use_code(df).where(F.col("DOR_UC").isin(*codes))


def keep_minimum_value(df: DataFrame, minimum: float = MIN_JUST_VALUE) -> DataFrame:
    return df.where(F.col("JV") >= minimum)


def value_fence(df: DataFrame, factor: float = FENCE_FACTOR) -> DataFrame:
    """One row: q1, q3 and the upper bound of unsuspicious values."""
    return _with_bound(exact_quantiles(df, "JV", _QUARTILES), factor)


def _with_bound(quartiles: DataFrame, factor: float) -> DataFrame:
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumn("upper_bound", F.col("q3") + F.lit(factor) * spread)


def eligible_leads(df: DataFrame) -> DataFrame:
    """Residential use and minimum value."""
    return keep_minimum_value(keep_residential(df))


def fit_fence(leads: DataFrame, factor: float = FENCE_FACTOR) -> float | None:
    """Upper bound of unsuspicious values among the eligible leads. Runs a
    job over two columns: fit on a stored table."""
    return value_fence(eligible_leads(leads), factor).first()["upper_bound"]


def sketch_load(leads: DataFrame) -> DataFrame:
    """The row of the sketch table for the leads of a load: what rows they are, and a
    sketch of the eligible values, in one pass."""
    eligible = F.col("DOR_UC").isin(*RESIDENTIAL_CODES) & (F.col("JV") >= MIN_JUST_VALUE)
    rows = pad_use_code(leads).select("OBJECTID", F.when(eligible, F.col("JV")).alias("JV"))
    return value_sketch(
        rows, "JV",
        F.min("OBJECTID").alias("first_id"), F.max("OBJECTID").alias("last_id"),
        F.count(F.lit(1)).alias("loaded"),
    )


def sketched_fence(sketches: DataFrame, factor: float = FENCE_FACTOR) -> DataFrame:
    """As :func:`value_fence`, from the sketches of all loads and without reading leads.
    The quartiles are approximate: their ranks are off by at most ``RANK_ERROR``."""
    return _with_bound(sketch_quantiles(sketches, _QUARTILES), factor)


def filter_leads(df: DataFrame, bound: Column | float | None = None) -> DataFrame:
    """Residential use, minimum value, then the fence of what is left.

    ``bound`` is the fitted fence (:func:`fit_fence`): as a number it reaches
    the scan, and no later step works the quartiles out again. Without it the
    values are counted here, in one pass, and the fence is part of the plan.
    """
    kept = eligible_leads(df)
    if bound is None:
        bound = value_fence(kept).select("upper_bound").scalar()
    elif not isinstance(bound, Column):
        bound = F.lit(float(bound))
    return kept.where(F.col("JV") <= bound)


# -- city ----------------------------------------------------------------------


def spell_city(df: DataFrame) -> DataFrame:
    """Upper-case city; 'NAN' is blank; known misspellings corrected."""
    city = normal_text("PHY_CITY", upper=True)
    fixed = F.when(city == "NAN", F.lit(""))
    for wrong, right in CITY_SPELLING.items():
        fixed = fixed.when(city == wrong, F.lit(right))
    return df.withColumn("PHY_CITY", fixed.otherwise(city))


def _city_of_zip(zip_code: Column) -> Column:
    pairs = [F.lit(part) for pair in ZIP_TO_CITY.items() for part in pair]
    return F.element_at(F.create_map(*pairs), zip_code)


def fill_city(df: DataFrame) -> DataFrame:
    """Blank cities from the ZIP code, else UNKNOWN."""
    zip_code = whole_number("PHY_ZIPCD")
    from_zip = F.coalesce(_city_of_zip(zip_code), F.lit(UNKNOWN_CITY))
    spelled = spell_city(df)
    return spelled.withColumns(
        {
            "PHY_ZIPCD": zip_code,
            "PHY_CITY": F.when(F.col("PHY_CITY") == "", from_zip).otherwise(
                F.col("PHY_CITY")
            ),
        }
    )


def unknown_city_share(df: DataFrame) -> DataFrame:
    """Share of unknown cities and whether it calls for a look."""
    unknown = F.col("PHY_CITY") == UNKNOWN_CITY
    share = F.avg(unknown.cast("double")) * 100
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(unknown).alias("unknown"),
        F.round(share, 4).alias("unknown_pct"),
    ).withColumn("warn", F.col("unknown_pct") > UNKNOWN_CITY_LIMIT_PCT)


# -- years and area --------------------------------------------------------------


def median_years(df: DataFrame) -> DataFrame:
    """Median known year per use code, and of all rows under ALL_CODES."""
    groups = F.explode(F.array("DOR_UC", F.lit(ALL_CODES)))
    known = df.where(F.col("ACT_YR_BLT") > 0)
    return exact_quantiles(
        known.select(groups.alias("DOR_UC"), "ACT_YR_BLT"),
        "ACT_YR_BLT", {"_code_year": 0.5}, ["DOR_UC"],
    )


def fill_actual_year(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Year 0 replaced by the median year of the use code, else of all rows.

    ``medians`` (:func:`median_years`, one row per code) join like any group
    value. Reaching a row to fill without any known year is an error.
    """
    if medians is None:
        medians = materialize(median_years(df), "median-years")
    overall = medians.where(F.col("DOR_UC") == ALL_CODES).select("_code_year").scalar()
    rows = df.join(medians, "DOR_UC", "left")
    none = F.raise_error(F.lit("no known year built in any row")).cast("double")
    filled = F.coalesce("_code_year", F.floor(overall).cast("double"), none)
    year = F.when(F.col("ACT_YR_BLT") == 0, filled).otherwise(F.col("ACT_YR_BLT"))
    return rows.withColumn("ACT_YR_BLT", whole_number(year)).select(*df.columns)


def fill_effective_year(df: DataFrame) -> DataFrame:
    """Year 0 replaced by the (repaired) actual year."""
    year = F.when(F.col("EFF_YR_BLT") == 0, F.col("ACT_YR_BLT")).otherwise(
        F.col("EFF_YR_BLT")
    )
    return df.withColumn("EFF_YR_BLT", whole_number(year))


def blank_living_area(df: DataFrame) -> DataFrame:
    return df.withColumn("TOT_LVG_AR", zero_to_null("TOT_LVG_AR"))


def repair_leads(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    filled = fill_effective_year(fill_actual_year(fill_city(df), medians))
    return blank_living_area(filled)


@dataclass
class CleaningStatistics:
    """What cleaning needs to know of all rows before it can treat one."""

    bound: float | None
    medians: DataFrame


def fit_cleaning(leads: DataFrame, sketches: DataFrame | None = None) -> CleaningStatistics:
    """Fence and median years, fitted in two narrow passes over stored leads; with the
    sketches of the loads, the fence is approximate and takes none."""
    bound = fit_fence(leads) if sketches is None else sketched_fence(sketches).first()["upper_bound"]
    medians = materialize(median_years(filter_leads(leads, bound)), "median-years")
    return CleaningStatistics(bound, medians)


def clean_leads(
    leads: DataFrame, statistics: CleaningStatistics | None = None
) -> DataFrame:
    """One pass over the leads, started by the caller. Statistics that were not
    fitted before are fitted here, which reads the leads several times."""
    if statistics is None:
        return repair_leads(filter_leads(leads))
    return repair_leads(filter_leads(leads, statistics.bound), statistics.medians)


def repair_counts(filtered: DataFrame) -> DataFrame:
    """What each repair fills and what is still missing after it."""
    with_before = spell_city(filtered).withColumns(
        {
            "_blank": F.col("PHY_CITY") == "",
            "_act0": F.col("ACT_YR_BLT") == 0,
            "_eff0": F.col("EFF_YR_BLT") == 0,
            "_area0": F.col("TOT_LVG_AR") == 0,
        }
    )
    after = repair_leads(with_before)
    unknown = F.col("PHY_CITY") == UNKNOWN_CITY
    return after.agg(
        F.count_if("_blank").alias("city_blank"),
        F.count_if(F.col("_blank") & ~unknown).alias("city_from_zip"),
        F.count_if(F.col("PHY_CITY") == UNKNOWN_CITY).alias("city_unknown"),
        F.count_if("_act0").alias("actual_year_filled"),
        F.count_if(F.col("ACT_YR_BLT") == 0).alias("actual_year_left"),
        F.count_if("_eff0").alias("effective_year_filled"),
        F.count_if(F.col("EFF_YR_BLT") == 0).alias("effective_year_left"),
        F.count_if("_area0").alias("area_blanked"),
        F.count_if(F.col("TOT_LVG_AR").isNull()).alias("area_missing"),
    )

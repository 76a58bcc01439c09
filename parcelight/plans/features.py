"""Engineered columns and the rule-based label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.constants import (
    CORPORATE_KEYWORDS,
    HOME_STATE,
    HOT_LEAD_SIGNALS,
    LABEL_COLUMN,
    MODEL_COLUMNS,
    OVERVALUED_RATIO,
    UNDERVALUED_RATIO,
)
from parcelight.functions import (
    ratio,
    signal_score,
    strip,
    value_tier,
    value_tier_code,
    whole_number,
)
from parcelight.operators import attach_group_values, require_columns

FLAGS = [
    "is_corporate_owner", "is_absentee_owner", "is_out_of_state_owner",
    "distressed_sale_history", "never_sold", "hot_lead",
]


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def property_age(as_of_year: int | None = None) -> Column:
    year = as_of_year or dt.date.today().year
    return F.greatest(F.lit(0), F.lit(year) - whole_number("ACT_YR_BLT"))


def corporate_owner() -> Column:
    """A keyword anywhere in the name counts, also inside a longer word."""
    return _flag(F.upper("OWN_NAME").rlike("|".join(CORPORATE_KEYWORDS)))


def absentee_owner() -> Column:
    return _flag(F.col("JV_HMSTD") == 0)


def out_of_state_owner(strict_nulls: bool = False) -> Column:
    """A state other than the home state. The text ``nan`` of a missing state
    counts as one; ``strict_nulls`` reads it as unknown."""
    inside = ["", HOME_STATE] + (["nan"] if strict_nulls else [])
    return _flag(~strip("OWN_STATE_").isin(*inside))


def price_per_sqft() -> Column:
    return F.coalesce(ratio("JV", "TOT_LVG_AR"), F.lit(0.0))


def lot_coverage() -> Column:
    return F.coalesce(ratio("TOT_LVG_AR", "LND_SQFOOT"), F.lit(0.0))


def land_ratio() -> Column:
    """Land share of the value; a value of 0 divides by 1."""
    return F.col("LND_VAL") / F.when(F.col("JV") == 0, 1.0).otherwise(F.col("JV"))


def renovation_gap() -> Column:
    return F.col("EFF_YR_BLT") - F.col("ACT_YR_BLT")


def distressed_sale() -> Column:
    return _flag(F.upper(strip("QUAL_CD1")).startswith("U"))


def never_sold() -> Column:
    return _flag(F.col("SALE_PRC1") == 0)


def with_neighborhood_ratio(df: DataFrame) -> DataFrame:
    """Value against the mean of its neighbourhood; 1.0 without one (also the
    unknown ones of leads built with ``strict_nulls``)."""
    means = (
        df.where(F.col("NBRHD_CD").isNotNull())
        .groupBy("NBRHD_CD")
        .agg(F.avg("JV").alias("_mean"))
    )
    own = F.coalesce(ratio("JV", "_mean"), F.lit(1.0))
    return (
        attach_group_values(df, means, "NBRHD_CD")
        .withColumn("neighborhood_value_ratio", own)
        .drop("_mean")
        .select(*df.columns, "neighborhood_value_ratio")
    )


def add_features(
    df: DataFrame, as_of_year: int | None = None, strict_nulls: bool = False
) -> DataFrame:
    """All engineered columns and the label, in table order."""
    row_wise = {
        "property_age": property_age(as_of_year),
        "is_corporate_owner": corporate_owner(),
        "is_absentee_owner": absentee_owner(),
        "is_out_of_state_owner": out_of_state_owner(strict_nulls),
        "price_per_sqft": price_per_sqft(),
        "lot_coverage_ratio": lot_coverage(),
        "renovation_gap": renovation_gap(),
        "value_tier": value_tier("JV"),
    }
    with_ratio = with_neighborhood_ratio(df.withColumns(row_wise))
    return with_ratio.withColumns(
        {
            "distressed_sale_history": distressed_sale(),
            "never_sold": never_sold(),
            "value_tier_encoded": value_tier_code("JV"),
        }
    ).withColumn(LABEL_COLUMN, hot_lead())


def hot_lead(threshold: int = HOT_LEAD_SIGNALS) -> Column:
    return (signal_score() >= threshold).cast("int")


def fill_model_columns(df: DataFrame) -> DataFrame:
    """Missing model inputs to 0; run after the ratios used them."""
    require_columns(df, [*MODEL_COLUMNS, LABEL_COLUMN], "features")
    zero = F.lit(0)
    return df.withColumns(
        {c: F.coalesce(c, zero.cast(df.schema[c].dataType)) for c in MODEL_COLUMNS}
    )


def engineer(
    clean: DataFrame, as_of_year: int | None = None, strict_nulls: bool = False
) -> DataFrame:
    return fill_model_columns(add_features(clean, as_of_year, strict_nulls))


# -- summaries ---------------------------------------------------------------


def flag_balance(df: DataFrame) -> DataFrame:
    """Count and percentage of every flag, one row per flag, in one pass."""
    ones = [F.sum(c).alias(f"{c}") for c in FLAGS]
    counted = df.agg(F.count(F.lit(1)).alias("_all"), *ones)
    return counted.unpivot("_all", FLAGS, "flag", "ones").select(
        "flag",
        "ones",
        (F.col("_all") - F.col("ones")).alias("zeros"),
        F.round(F.try_divide(F.col("ones") * F.lit(100.0), "_all"), 4).alias("pct"),
    )


def signal_histogram(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(signal_score().alias("signals"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("signals")
    )


def tier_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("value_tier", "value_tier_encoded")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("value_tier_encoded")
    )


def valuation_counts(df: DataFrame) -> DataFrame:
    own = F.col("neighborhood_value_ratio")
    return df.agg(
        F.count_if(own < UNDERVALUED_RATIO).alias("undervalued"),
        F.count_if(own > OVERVALUED_RATIO).alias("overvalued"),
    )


def top_groups_by_size(
    df: DataFrame, key: str = "NBRHD_CD", value: str = "JV", n: int = 5
) -> DataFrame:
    """Mean value and size of the largest groups."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.round(F.avg(value), 4).alias("mean"), F.count(value).alias("n"))
        .orderBy(F.desc("n"), key)
        .limit(n)
    )

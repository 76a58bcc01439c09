"""Data-quality profiles of source tables, leads and features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.constants import (
    HOME_STATE,
    LEAD_COLUMNS,
    MIN_JUST_VALUE,
    RESIDENTIAL_CODES,
)
from parcelight.functions import bucket_label, code_prefix, parse_number, strip
from parcelight.operators import (
    condition_counts,
    exact_quantiles,
    first_by_key,
    long_form,
    top_counts,
)
from parcelight.plans.cleaning import (
    keep_minimum_value,
    keep_residential,
    pad_use_code,
    value_fence,
)
from parcelight.plans.features import corporate_owner, land_ratio
from parcelight.plans.ingest import newest_first
from parcelight.sources import LeadTables

ZERO_PROFILE = [
    "JV", "ACT_YR_BLT", "EFF_YR_BLT", "TOT_LVG_AR", "SALE_PRC1", "SALE_PRC2",
    "LND_SQFOOT", "NO_BULDNG", "JV_HMSTD",
]
TEXT_PROFILE = ["PHY_CITY", "OWN_NAME", "OWN_STATE_", "QUAL_CD1", "NBRHD_CD"]


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def out_of_state() -> Column:
    return _filled("OWN_STATE_") & (F.col("OWN_STATE_") != HOME_STATE)


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def summary_stats(leads: DataFrame) -> DataFrame:
    """One-row overview of the leads table."""
    value = F.when(F.col("JV") > 0, F.col("JV"))

    def money(c: Column) -> Column:
        return F.coalesce(F.round(c, 2), F.lit(0.0))

    return leads.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("PHY_CITY").alias("unique_cities"),
        F.countDistinct("PHY_ZIPCD").alias("unique_zips"),
        money(F.min(value)).alias("min_value"),
        money(F.max(value)).alias("max_value"),
        money(F.avg(value)).alias("avg_value"),
        F.count_if(F.col("TOT_LVG_AR") > 0).alias("has_living_area"),
        F.count_if(F.col("SALE_PRC2") > 0).alias("has_second_sale"),
        F.count_if(out_of_state()).alias("out_of_state_owners"),
    )


def value_counts_by_column(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """Most frequent values of several columns: one (column, value, n) table,
    from one scan and one count."""
    texts = df.select(*[F.col(c).cast("string") for c in columns])
    counts = (
        texts.unpivot([], columns, "column", "value").where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        counts.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= n).drop("_place")
    )


def _null_checks(columns: list[str]) -> dict[str, Column]:
    checks = {}
    for c in LEAD_COLUMNS:
        if c not in columns:
            continue
        checks[f"{c}:nulls"] = F.col(c).isNull()
        if c in ZERO_PROFILE:
            checks[f"{c}:zeros"] = F.col(c) == 0
        if c in TEXT_PROFILE:
            checks[f"{c}:empty"] = strip(c) == ""
    return checks


def _coverage_checks() -> dict[str, Column]:
    positive = [
        "TOT_LVG_AR", "EFF_YR_BLT", "LND_SQFOOT", "SALE_PRC1", "SALE_PRC2",
        "SALE_YR2", "NO_BULDNG", "JV_HMSTD", "ACT_YR_BLT",
    ]
    checks = {c: F.col(c) > 0 for c in positive}
    checks.update({c: _filled(c) for c in ("QUAL_CD1", "NBRHD_CD", "OWN_STATE_")})
    checks["out_of_state"] = out_of_state()
    return checks


def _ranges() -> dict[str, list[tuple[str, Column]]]:
    """Ranges of values and sale years; no row is in two of a column."""
    value, year = F.col("JV"), F.col("SALE_YR1")
    return {
        "JV": [
            ("zero", value == 0),
            ("under 50k", (value > 0) & (value < 50_000)),
            ("50k-200k", (value >= 50_000) & (value < 200_000)),
            ("200k-500k", (value >= 200_000) & (value < 500_000)),
            ("500k and over", value >= 500_000),
        ],
        "SALE_YR1": [
            ("never sold", year == 0),
            ("before 2000", (year > 0) & (year < 2000)),
            ("2000-2014", (year >= 2000) & (year < 2015)),
            ("2015-2019", (year >= 2015) & (year < 2020)),
            ("2020 and later", year >= 2020),
        ],
    }


def nulls_and_zeros(leads: DataFrame) -> DataFrame:
    """Nulls of every lead column, zeros and empty texts of those that have
    such a meaning; one scan."""
    rows = long_form(condition_counts(leads, _null_checks(leads.columns)), "_check", "n")
    return rows.select(
        F.split_part("_check", F.lit(":"), F.lit(1)).alias("column"),
        F.split_part("_check", F.lit(":"), F.lit(2)).alias("check"),
        "n",
    )


def field_coverage(leads: DataFrame) -> DataFrame:
    """Rows that carry each optional field."""
    return long_form(condition_counts(leads, _coverage_checks()), "field", "n")


def range_buckets(leads: DataFrame) -> DataFrame:
    """Rows per value range and per sale-year range."""
    labels = leads.select(*[bucket_label(ranges).alias(c) for c, ranges in _ranges().items()])
    return (
        labels.groupBy("JV", "SALE_YR1")  # at most 25 groups leave the scan
        .agg(F.count(F.lit(1)).alias("n"))
        .unpivot("n", ["JV", "SALE_YR1"], "column", "bucket")
        .where(F.col("bucket").isNotNull())
        .groupBy("column", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def load_checks() -> dict[str, Column]:
    """The conditions of the three profiles above, to be counted while leads are
    written; named ``profile:column:label``."""
    checks = {f"nulls:{name}": c for name, c in _null_checks(LEAD_COLUMNS).items()}
    checks.update({f"coverage:{name}:filled": c for name, c in _coverage_checks().items()})
    for column, ranges in _ranges().items():
        checks.update({f"bucket:{column}:{label}": c for label, c in ranges})
    return checks


def load_profile(tables: LeadTables, table: str = "leads") -> DataFrame:
    """(profile, column, label, n) of a stored table: the sums of what its loads have
    counted, without reading a row. If one has not counted, all rows are read, once."""
    checks, parts = load_checks(), tables.parts(table)
    if all(checks.keys() <= part.counts.keys() for part in parts):
        sums = [(name, sum(p.counts[name] for p in parts)) for name in checks]
        rows = tables.spark.createDataFrame(sums, "_check string, n bigint")
    else:
        rows = long_form(condition_counts(tables.read(table), checks), "_check", "n")
    at = [F.split_part("_check", F.lit(":"), F.lit(i)) for i in (1, 2, 3)]
    return rows.select(at[0].alias("profile"), at[1].alias("column"), at[2].alias("label"), "n")


def describe_numbers(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Per column: nulls, zeros, rows below its threshold, smallest positive
    value, min, max, mean and exact median.

    The columns become (column, value) rows, so any number of them costs one
    pass for the counts and one for the medians.
    """
    columns = list(thresholds)
    numbers = df.select(*[F.col(c).cast("double") for c in columns])
    rows = numbers.unpivot([], columns, "column", "value")
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair])
    value = F.col("value")
    below = value < F.element_at(limits, F.col("column"))
    stats = rows.groupBy("column").agg(
        F.count_if(value.isNull()).alias("nulls"),
        F.count_if(value == 0).alias("zeros"),
        F.count_if(below).alias("below"),
        F.round(F.min(F.when(value > 0, value)), 4).alias("min_positive"),
        F.round(F.min(value), 4).alias("min"),
        F.round(F.max(value), 4).alias("max"),
        F.round(F.avg(value), 4).alias("mean"),
    )
    medians = exact_quantiles(rows, "value", {"median": 0.5}, ["column"]).select(
        "column", F.round("median", 4).alias("median")
    )
    return stats.join(F.broadcast(medians), "column", "left")  # a row per column


def tax_years(history: DataFrame) -> DataFrame:
    """First and last tax year, and rows whose year cannot be read."""
    year = parse_number("Hist_Tax_Year")
    return history.agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.count_if(year.isNull()).alias("unreadable"),
    )


def owner_profile(owners: DataFrame) -> DataFrame:
    """Home-state, out-of-state (missing states left out) and corporate owners."""
    state = strip("Owner_Mail_State")
    away = ~state.isin(HOME_STATE, "", "nan")
    named = owners.withColumn("OWN_NAME", F.col("Owner_Mail_Name"))
    return named.agg(
        F.count(F.lit(1)).alias("owners"),
        F.count_if(state == HOME_STATE).alias("home_state"),
        F.count_if(away).alias("out_of_state"),
        F.sum(corporate_owner()).alias("corporate"),
        F.round(F.avg(corporate_owner()) * 100, 4).alias("corporate_pct"),
    )


def join_coverage(
    tables: Mapping[str, DataFrame], base: str = "property", key: str = "Parcel"
) -> DataFrame:
    """For each table: how many distinct base keys it holds.

    All tables go through one shuffle: a key's presence flags are combined by
    ``max`` before and after it.
    """
    names = [n for n in tables if n != base]
    tagged = None
    for name, df in tables.items():
        keys = df.where(F.col(key).isNotNull()).select(
            key, *[F.lit(int(n == name)).alias(n) for n in tables]
        )
        tagged = keys if tagged is None else tagged.unionByName(keys)
    present = tagged.groupBy(key).agg(*[F.max(n).alias(n) for n in tables])
    counted = present.where(F.col(base) == 1).agg(
        F.count(F.lit(1)).alias("_base"),
        *[F.sum(n).alias(n) for n in names],
    )
    return counted.unpivot("_base", names, "source", "matched").select(
        "source",
        "matched",
        F.col("_base").alias("base_keys"),
        F.round(F.try_divide(F.col("matched") * F.lit(100.0), "_base"), 4).alias("pct"),
    )


def common_keys(
    left: DataFrame, right: DataFrame, key: str = "Parcel"
) -> DataFrame:
    """Distinct keys present on both sides. Each side is made distinct before
    the join, so a key's repeats never travel."""
    known = left.where(F.col(key).isNotNull())
    return known.select(key).distinct().join(
        right.select(key).distinct(), key, "left_semi"
    )


def survival_estimate(
    property_rows: DataFrame, history: DataFrame, codes=RESIDENTIAL_CODES
) -> DataFrame:
    """Rows left after the use-code and minimum-value filters, before the full
    build. Rows are counted per parcel before they meet the latest values."""
    residential = code_prefix("Prop_Use_Code").isin(*codes)
    per_parcel = property_rows.groupBy("Parcel").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(residential).alias("_res")
    )
    valued = latest_values(history, ["Just_Value"]).where(
        F.col("Just_Value") >= MIN_JUST_VALUE
    )
    kept = F.when(F.col("Just_Value").isNotNull(), F.col("_res"))
    return _as_steps(
        per_parcel.join(valued, "Parcel", "left").agg(
            F.sum("_all").alias("all"),
            F.sum("_res").alias("residential"),
            F.coalesce(F.sum(kept), F.lit(0)).alias("minimum value"),
        )
    )


def _as_steps(one_row: DataFrame) -> DataFrame:
    """Column per filter to one row per filter, with the rows it removed."""
    names = one_row.columns
    left = F.array(*[F.col(f"`{n}`") for n in names])
    return one_row.select(
        F.posexplode(left).alias("_at", "rows"), left.alias("_left")
    ).select(
        (F.col("_at") + 1).alias("step"),
        F.element_at(F.array(*map(F.lit, names)), F.col("_at") + 1).alias("filter"),
        "rows",
        F.coalesce(F.get("_left", F.col("_at") - 1) - F.col("rows"), F.lit(0))
        .cast("bigint").alias("removed"),
    )


def survival_funnel(leads: DataFrame) -> DataFrame:
    """Rows left and removed at each cleaning filter, from one scan of leads
    (plus the fence)."""
    padded = pad_use_code(leads)
    fence = value_fence(keep_minimum_value(keep_residential(leads)))
    bound = fence.select("upper_bound").scalar()
    residential = F.col("DOR_UC").isin(*RESIDENTIAL_CODES)
    valued = residential & (F.col("JV") >= MIN_JUST_VALUE)
    steps = {
        "all": F.lit(True),
        "residential": residential,
        "minimum value": valued,
        "value fence": valued & (F.col("JV") <= bound),
    }
    return _as_steps(condition_counts(padded, steps))


def rule_compare(sales: DataFrame) -> DataFrame:
    """Matches of the exact and the prefix reading of the sale code."""
    code = F.upper(strip("DOR_Qual_Code"))
    return sales.agg(
        F.count_if(code == "U").alias("exact_rule"),
        F.count_if(code.startswith("U")).alias("prefix_rule"),
    )


def matched_codes(sales: DataFrame) -> DataFrame:
    code = F.upper(strip("DOR_Qual_Code"))
    return top_counts(sales.where(code.startswith("U")), "DOR_Qual_Code")


def range_violations(features: DataFrame, as_of_year: int) -> DataFrame:
    """Rows per implausible-value rule."""
    checks = {
        "negative_age": F.lit(as_of_year) - F.col("ACT_YR_BLT") < 0,
        "land_ratio_over_1": land_ratio() > 1.0,
        "lot_coverage_over_1": F.col("lot_coverage_ratio") > 1.0,
    }
    return long_form(condition_counts(features, checks), "rule", "violations")


def latest_values(history: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of each parcel's latest tax year, as numbers."""
    known = history.where(F.col("Parcel").isNotNull())
    latest = first_by_key(known, "Parcel", columns, newest_first())
    return latest.select("Parcel", *[parse_number(c).alias(c) for c in columns])

"""Six appraisal tables to one wide row per parcel."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelight.constants import LEAD_COLUMNS, LEAD_TEXT_COLUMNS, NON_BUILDING_TYPES
from parcelight.functions import (
    code_prefix,
    normal_text,
    number_or_zero,
    parse_number,
    strip,
    year_prefix,
    zip5,
)
from parcelight.operators import (
    first_by_key,
    join_key,
    number_rows,
    require_columns,
    restore_key,
)
from parcelight.sources.tsv import ORDINAL

KEY = "_key"


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY, join_key("Parcel"))


def _unkeyed(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != KEY]
    return df.select(restore_key(KEY).alias("Parcel"), *rest)


# -- keyed forms: one row per parcel, hash-partitioned by _key -----------------
#
# The winning row is chosen on the raw text; only winners are parsed.


def _property(df: DataFrame, strict_nulls: bool) -> DataFrame:
    columns = ["Prop_Use_Code", "City_Desc", "NBHD_Code", ORDINAL]
    first = first_by_key(_keyed(df), KEY, columns, F.col(ORDINAL))
    return first.select(
        KEY,
        code_prefix("Prop_Use_Code").alias("DOR_UC"),
        normal_text("City_Desc", True, strict_nulls).alias("PHY_CITY"),
        normal_text("NBHD_Code", strict_nulls=strict_nulls).alias("NBRHD_CD"),
        ORDINAL,
    )


def _owners(df: DataFrame, strict_nulls: bool) -> DataFrame:
    texts = {
        "OWN_NAME": "Owner_Mail_Name",
        "OWN_ADDR1": "Owner_Mail_Addr1",
        "OWN_STATE_": "Owner_Mail_State",
    }
    columns = [*texts.values(), "Owner_Mail_Zip"]
    first = first_by_key(_keyed(df), KEY, columns, F.col(ORDINAL))
    return first.select(
        KEY,
        *[
            normal_text(raw, strict_nulls=strict_nulls).alias(c)
            for c, raw in texts.items()
        ],
        zip5("Owner_Mail_Zip").alias("PHY_ZIPCD"),
    )


def newest_first() -> Column:
    """Order of history rows: latest tax year, unreadable years last."""
    year = parse_number("Hist_Tax_Year")
    return F.struct(
        F.coalesce(-year, F.lit(float("inf"))).alias("age"), F.col(ORDINAL)
    )


def _history(df: DataFrame) -> DataFrame:
    columns = ["Just_Value", "Land_Value", "County_Exempt_Amount"]
    return first_by_key(_keyed(df), KEY, columns, newest_first()).select(
        KEY,
        number_or_zero("Just_Value").alias("JV"),
        number_or_zero("Land_Value").alias("LND_VAL"),
        number_or_zero("County_Exempt_Amount").alias("JV_HMSTD"),
        F.lit(0.0).alias("JV_CHNG"),
    )


def _land(df: DataFrame) -> DataFrame:
    return (
        _keyed(df.where(F.col("Parcel").isNotNull()))
        .groupBy(KEY)
        .agg(F.sum(number_or_zero("Land_SqFt")).alias("LND_SQFOOT"))
    )


def _improvements(df: DataFrame) -> DataFrame:
    buildings = _keyed(
        drop_non_buildings(df).where(F.col("Parcel").isNotNull())
    ).withColumn("area", number_or_zero("Heated_SquareFeet"))
    # The order comes first and is total, so the smallest struct is the winner's: one
    # buffer to compare and to shuffle, where ``min_by`` has two.
    largest_first = F.struct(
        (-F.col("area")).alias("by_area"), F.col(ORDINAL), "Actual_YrBlt", "Effective_YrBlt"
    )
    return (
        buildings.groupBy(KEY)
        .agg(
            F.min(largest_first).alias("largest"),
            F.countDistinct("Bldg_Num").cast("int").alias("NO_BULDNG"),
        )
        .select(
            KEY,
            number_or_zero(F.col("largest.Actual_YrBlt")).alias("ACT_YR_BLT"),
            number_or_zero(F.col("largest.Effective_YrBlt")).alias("EFF_YR_BLT"),
            (-F.col("largest.by_area")).alias("TOT_LVG_AR"),
            "NO_BULDNG",
            F.col("NO_BULDNG").alias("NO_RES_UNT"),
        )
    )


def _sales(df: DataFrame) -> DataFrame:
    lines = _keyed(df).withColumn("line", parse_number("Sale_Line_Num"))

    def first_of(number: int, *columns: str) -> Column:
        on_line = F.when(F.col("line") == number, F.col(ORDINAL))
        return F.min_by(F.struct(*columns), on_line)

    return (
        lines.where(F.col("line").isin(0.0, 1.0))
        .groupBy(KEY)
        .agg(
            first_of(0, "Sale_Price", "Sale_Date", "DOR_Qual_Code").alias("latest"),
            first_of(1, "Sale_Price", "Sale_Date").alias("previous"),
        )
        .where(F.col("latest").isNotNull())
        .select(
            KEY,
            number_or_zero(F.col("latest.Sale_Price")).alias("SALE_PRC1"),
            year_prefix(F.col("latest.Sale_Date")).alias("SALE_YR1"),
            F.coalesce("latest.DOR_Qual_Code", F.lit("")).alias("QUAL_CD1"),
            number_or_zero(F.col("previous.Sale_Price")).alias("SALE_PRC2"),
            year_prefix(F.col("previous.Sale_Date")).alias("SALE_YR2"),
        )
    )


# -- public forms -------------------------------------------------------------


def drop_non_buildings(improvements: DataFrame) -> DataFrame:
    """Without ownership-history lines; a missing type is kept."""
    kind = F.coalesce("Imprv_Type", F.lit(""))
    # Most types do not even hold such a name; only the others are stripped.
    holds = reduce(or_, [F.contains(kind, F.lit(name)) for name in NON_BUILDING_TYPES])
    return improvements.where(~(holds & strip(kind).isin(*NON_BUILDING_TYPES)))


def prepare_property(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return _unkeyed(_property(df, strict_nulls)).drop(ORDINAL)


def prepare_owners(df: DataFrame, strict_nulls: bool = False) -> DataFrame:
    return _unkeyed(_owners(df, strict_nulls))


def prepare_history(df: DataFrame) -> DataFrame:
    """Values of the latest tax year; unreadable years come last."""
    return _unkeyed(_history(df))


def prepare_land(df: DataFrame) -> DataFrame:
    return _unkeyed(_land(df))


def prepare_improvements(df: DataFrame) -> DataFrame:
    """Largest building and number of buildings."""
    return _unkeyed(_improvements(df))


def prepare_sales(df: DataFrame) -> DataFrame:
    """Latest and previous sale; parcels without a line 0 have no row."""
    return _unkeyed(_sales(df))


def fill_missing(leads: DataFrame, strict_nulls: bool = False) -> DataFrame:
    """Missing numbers to 0 and missing text to '', over the lead columns.
    ``strict_nulls`` leaves an unknown neighbourhood missing: it is no group."""
    numbers = [
        c for c in LEAD_COLUMNS
        if c in leads.columns and c not in LEAD_TEXT_COLUMNS and c != "OBJECTID"
    ]
    missing = {"Parcel", "NBRHD_CD"} if strict_nulls else {"Parcel"}
    texts = [c for c in LEAD_TEXT_COLUMNS if c in leads.columns and c not in missing]
    return leads.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numbers},
            **{c: F.coalesce(c, F.lit("")) for c in texts},
        }
    )


def build_leads(
    tables: Mapping[str, DataFrame],
    numbered: bool = True,
    strict_nulls: bool = False,
) -> DataFrame:
    """The leads table: every property row, left-joined to the other five.

    Each side is already reduced to one row per parcel by an aggregation that
    hash-partitions and sorts by the join key, so the five joins add neither
    a shuffle nor a sort. Rows are numbered on the narrow property side, in
    file order, before anything is joined to it.
    """
    parcels = _property(tables["property"], strict_nulls)
    if numbered:
        parcels = number_rows(parcels, [F.col(ORDINAL)], "OBJECTID")
    joined = parcels
    for side in (
        _owners(tables["owners"], strict_nulls),
        _history(tables["history"]),
        _land(tables["land"]),
        _improvements(tables["improvements"]),
        _sales(tables["sales"]),
    ):
        joined = joined.join(side, KEY, "left")
    # There is no site address in the source: the owner's address stands in.
    leads = _unkeyed(joined).withColumn("PHY_ADDR1", F.col("OWN_ADDR1"))
    columns = LEAD_COLUMNS if numbered else LEAD_COLUMNS[1:]
    return select_lead_columns(fill_missing(leads, strict_nulls), columns)


def select_lead_columns(
    leads: DataFrame, columns: list[str] = LEAD_COLUMNS
) -> DataFrame:
    """The lead columns in their fixed order; an error names missing ones."""
    return require_columns(leads, columns, "leads").select(*columns)


def resume_slice(leads: DataFrame, loaded: int, goal: int | None) -> DataFrame:
    """Rows still to load after ``loaded`` rows, up to ``goal`` in total."""
    rest = leads.where(F.col("OBJECTID") > loaded)
    return rest if goal is None else rest.where(F.col("OBJECTID") <= goal)

"""The ranked deliverable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelight.constants import DETAIL_COLUMNS, EXPORT_COLUMNS, EXPORT_INT_COLUMNS
from parcelight.functions import temperature


def with_details(scores: DataFrame, leads: DataFrame) -> DataFrame:
    """Scores left-joined to the detail columns on OBJECTID.

    Only id, score and rank of the scores, and sixteen columns of the leads,
    reach the join. Both sides are unique by id, so no key is hot.
    """
    slim = [c for c in ("hot_lead_score", "rank") if c in scores.columns]
    left = scores.select(F.col("OBJECTID").cast("bigint").alias("OBJECTID"), *slim)
    details = leads.select(
        F.col("OBJECTID").cast("bigint").alias("OBJECTID"), *DETAIL_COLUMNS[1:]
    )
    return left.join(details, "OBJECTID", "left")


def matched_count(joined: DataFrame) -> DataFrame:
    return joined.agg(
        F.count(F.lit(1)).alias("records"), F.count("OWN_NAME").alias("matched")
    )


def with_temperature(df: DataFrame) -> DataFrame:
    return df.withColumn("temperature", temperature("hot_lead_score"))


def temperature_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("temperature").agg(F.count(F.lit(1)).alias("n"))


def export_layout(df: DataFrame) -> DataFrame:
    """Export columns in order, whole numbers as integers, sorted by rank."""
    whole = {c: "int" for c in EXPORT_INT_COLUMNS}
    whole.update(rank="bigint", OBJECTID="bigint")
    columns = [
        F.coalesce(F.col(c).try_cast(whole[c]), F.lit(0)).cast(whole[c]).alias(c)
        if c in whole else F.col(c)
        for c in EXPORT_COLUMNS
        if c in df.columns
    ]
    return df.select(*columns).orderBy("rank")


def export_leads(scores: DataFrame, leads: DataFrame) -> DataFrame:
    return export_layout(with_temperature(with_details(scores, leads)))

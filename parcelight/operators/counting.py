"""Counts: per value, per condition, and as rows instead of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_counts(
    df: DataFrame, column: str, n: int | None = None, value_name: str = "value"
) -> DataFrame:
    """Rows per value, most frequent first; equal counts in value order."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(value_name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), value_name)
    )
    return counts if n is None else counts.limit(n)


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with the number of rows meeting each condition, in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def long_form(one_row: DataFrame, label: str, value: str) -> DataFrame:
    """A one-row result as (label, value) rows."""
    return one_row.unpivot([], list(one_row.columns), label, value)

"""Banding of values and scores, and the signal score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelight.constants import (
    HOT_SCORE,
    OLD_PROPERTY_YEARS,
    UNDERVALUED_RATIO,
    VALUE_TIERS,
    WARM_SCORE,
)
from parcelight.functions.text import _col


def _by_tier(value: Column, results: list) -> Column:
    """Right-closed bins: a value equal to an upper edge is in that tier."""
    out = F.when(value <= 0, None)
    for (_, upper), result in zip(VALUE_TIERS, results):
        out = out.when(value <= upper, F.lit(result))
    return out


def value_tier(value: Column | str) -> Column:
    """Tier name; NULL for a missing or non-positive value."""
    return _by_tier(_col(value), [name for name, _ in VALUE_TIERS])


def value_tier_code(value: Column | str) -> Column:
    """Tier as 0..4; 0 for a missing or non-positive value."""
    return F.coalesce(
        _by_tier(_col(value), list(range(len(VALUE_TIERS)))), F.lit(0)
    )


def temperature(score: Column | str) -> Column:
    score = _col(score)
    return (
        F.when(score >= HOT_SCORE, "HOT")
        .when(score >= WARM_SCORE, "WARM")
        .otherwise("COLD")
    )


def signal_score() -> Column:
    """Number of seller signals (0..7) over the engineered columns."""
    low_tiers = [name for name, _ in VALUE_TIERS[:2]]
    signals = [
        F.col("never_sold") == 1,
        F.col("is_absentee_owner") == 1,
        F.col("is_out_of_state_owner") == 1,
        F.col("property_age") > OLD_PROPERTY_YEARS,
        F.col("value_tier").isin(*low_tiers),
        F.col("neighborhood_value_ratio") < UNDERVALUED_RATIO,
        F.col("distressed_sale_history") == 1,
    ]
    total = F.lit(0)
    for signal in signals:
        total = total + F.coalesce(signal, F.lit(False)).cast("int")
    return total


def bucket_label(buckets: list[tuple[str, Column]]) -> Column:
    """Label of the first bucket whose condition holds, else NULL."""
    (label, condition), *rest = buckets
    out = F.when(condition, label)
    for label, condition in rest:
        out = out.when(condition, label)
    return out

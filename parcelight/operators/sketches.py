"""Approximate quantiles from summaries that can be stored and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a sketch: about 100 KB, whatever the rows.
SKETCH_K = 4_096
# The rank of an answer is off by at most this share of the rows, with a probability of
# 99 %: 2.296 / k ** 0.9723, as published for these (KLL) sketches.
RANK_ERROR = 2.296 / SKETCH_K**0.9723


def value_sketch(df: DataFrame, value: str, *others: Column) -> DataFrame:
    """One row: a sketch of the finite values (none: a sketch of nothing), from partial
    sketches of each task, after the other aggregates."""
    number = F.col(value).cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    return df.agg(*others, F.kll_sketch_agg_double(finite, F.lit(SKETCH_K)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """One row with each named quantile of all rows behind the sketches: a value that
    occurs, whose rank is within :data:`RANK_ERROR` of the wanted one. Nothing behind
    them: missing values."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("_all"))
    some = F.kll_sketch_get_n_double("_all") > 0
    return merged.select(
        *[
            F.when(some, F.kll_sketch_get_quantile_double("_all", F.lit(float(p)))).alias(name)
            for name, p in quantiles.items()
        ]
    )

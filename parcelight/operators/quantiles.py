"""Exact interpolated quantiles without a whole column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.storage import materialize, materialize_counted

# Bits told apart per level, and the distinct values that may be put in order in a task.
_DIGIT = 16
_FEW = 100_000


def ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a whole number with the same order."""
    bits = F.java_method(
        F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value
    ).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def _leading(shift: int) -> Column:
    """The leading bits of a value, without the last ``shift``."""
    return F.lit(0).cast("bigint") if shift == 64 else F.shiftright("_bits", shift)


def _wanted(quantiles: dict[str, float]) -> Column:
    """Places (0-based, of ``_n``) on both sides of each quantile."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(side).alias("side"),
                rounded(F.lit(p) * (F.col("_n") - 1)).cast("bigint").alias("at"),
            )
            for name, p in quantiles.items()
            for side, rounded in (("low", F.floor), ("high", F.ceil))
        ]
    )


def _selected(counts: DataFrame, by: list[str], quantiles: dict[str, float]) -> DataFrame:
    """``counts`` narrowed to the values that share leading bits with a wanted one, as
    many bits as it takes: with ``_n`` rows in the group, ``_before`` rows below the
    first of them, and the ``_places`` wanted among them.

    A level is a histogram of the next bits within the prefixes that hold a place, one
    pass over the stored counts; what it finds, a few rows a group, is stored.
    """
    hits = counts.groupBy(*by).agg(
        F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_values")
    ).select(
        *by, F.lit(0).cast("bigint").alias("_prefix"), "_n", "_values",
        F.lit(0).cast("bigint").alias("_before"), _wanted(quantiles).alias("_places"),
    )
    hits, shift = materialize(hits, "quantile-groups"), 64
    on = [*by, "_prefix"]
    up_to_here = Window.partitionBy(*on).orderBy("_next").rowsBetween(
        Window.unboundedPreceding, 0
    )
    while shift and not hits.where(F.col("_values") > _FEW).isEmpty():
        inside = counts.withColumn("_prefix", _leading(shift)).join(hits.drop("_values"), on)
        shift -= _DIGIT
        sums = inside.groupBy(*on, _leading(shift).alias("_next")).agg(
            F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_values"),
            *[F.first(c).alias(c) for c in ("_n", "_before", "_places")],
        )
        through = F.col("_before") + F.sum("_c").over(up_to_here)
        reached = sums.withColumn("_through", through).select(
            *by, F.col("_next").alias("_prefix"), "_n", "_values",
            (F.col("_through") - F.col("_c")).alias("_before"),
            F.filter(
                "_places",
                lambda p: (p["at"] < F.col("_through"))
                & (p["at"] >= F.col("_through") - F.col("_c")),
            ).alias("_places"),
        )
        hits = materialize(reached.where(F.size("_places") > 0), "quantile-prefixes")
    return counts.withColumn("_prefix", _leading(shift)).join(hits.drop("_values"), on)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row (per group) with each named quantile, linearly interpolated.

    Equal values are counted together, with map-side combine, and the counts are stored:
    a job that runs here, the only pass over ``df``. Few distinct values are put in order
    as they are. Otherwise the wanted ones are selected by the digits of their
    order-preserving bits, a histogram of the next 16 bits a level, until few values are
    left: four levels at most, whatever the values. The answer is exact. Missing and
    non-finite values and missing groups are left out.
    """
    by = list(by)
    number = F.col(value).cast("double")
    usable = F.abs(number) < float("inf")  # nor NaN
    for key in by:
        usable = usable & F.col(key).isNotNull()
    counts, distinct = materialize_counted(
        df.where(usable)
        .groupBy(*by, number.alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_bits", ordered_bits(F.col("_v"))),
        "value-counts",
    )
    if distinct <= _FEW:
        near = counts.select(
            "*", F.sum("_c").over(Window.partitionBy(*by)).alias("_n"),
            F.lit(0).cast("bigint").alias("_prefix"), F.lit(0).cast("bigint").alias("_before"),
        ).withColumn("_places", _wanted(quantiles))
    else:
        near = _selected(counts, by, quantiles)

    in_order = Window.partitionBy(*by, "_prefix").orderBy("_bits").rowsBetween(
        Window.unboundedPreceding, 0
    )
    through = F.col("_before") + F.sum("_c").over(in_order)
    picked = (
        near.withColumn("_through", through)
        .select(*by, "_v", "_c", "_n", "_through", F.inline("_places"))
        .where("at < _through AND at >= _through - _c")
    )

    def interpolated(name: str, p: float) -> Column:
        def value_at(side: str) -> Column:
            hit = (F.col("name") == name) & (F.col("side") == side)
            return F.max(F.when(hit, F.col("_v")))

        place = F.lit(p) * (F.max("_n") - 1)
        low, high = value_at("low"), value_at("high")
        return low + (high - low) * (place - F.floor(place))

    return picked.groupBy(*by).agg(
        *[interpolated(name, p).alias(name) for name, p in quantiles.items()]
    )

"""Dense sequential numbers over a whole distributed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelight.storage import materialize

# monotonically_increasing_id(): partition number above bit 33, row below.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order: list[Column], name: str, start: int = 1
) -> DataFrame:
    """Adds ``name`` = start, start+1, ... in ``order``, which must be total.

    One range shuffle sorts the rows into ordered slices. Each row's place in
    its slice is written out with it, so the numbers cannot shift when a task
    is retried or the plan adapts; the slice sizes (one row per sort
    partition) then give every slice its offset. A tie in the leading order
    column is split over slices like any other range, since the full order is
    unique.
    """
    place = F.monotonically_increasing_id()
    stored = materialize(df.orderBy(*order).withColumn("_place", place), name)
    slice_no = F.shiftright("_place", _ROW_BITS)

    sizes = stored.groupBy(slice_no.alias("_slice")).agg(
        F.count(F.lit(1)).alias("_size")
    )
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    # One row per sort partition, so broadcasting it is bounded by the plan.
    numbered = stored.withColumn("_slice", slice_no).join(
        F.broadcast(offsets), "_slice"
    )
    in_slice = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.withColumn(
        name, F.col("_before") + in_slice + F.lit(start)
    ).drop("_slice", "_place", "_before")

"""Joining group values back to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelight.storage import materialize


def attach_group_values(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Left join of ``groups`` (one row per ``key``) to every row of ``df``.

    ``groups`` is written first, so its bytes are known: Spark broadcasts it
    below its threshold and otherwise shuffles both sides, where adaptive
    execution splits the partition of a hot key on the side of ``df``.
    """
    return df.join(materialize(groups, f"groups-{key}"), key, "left")

"""One row per key.

A fixed-size ``min_by`` buffer replaces a window: rows combine on the map
side, so a key that holds a third of the table reaches its reducer as one
partial row per map task. Which row wins is decided by an explicit order,
never by arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stands for a missing key while joining: missing keys match each other here.
# The character cannot occur in a text file.
NULL_KEY = "\u0000"


def join_key(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(NULL_KEY))


def restore_key(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(NULL_KEY))


def first_by_key(
    df: DataFrame, key: str, columns: Sequence[str], order: Column
) -> DataFrame:
    """``columns`` of each key's row with the smallest ``order``."""
    winner = F.min_by(F.struct(*columns), order)
    return df.groupBy(key).agg(winner.alias("_row")).select(key, "_row.*")

"""Deterministic row hash for splits and folds.

The hash depends only on the row id and the seed, so a split is the same for
any partitioning, cluster size or retry, and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelight.functions.text import _col

_MULTIPLIER = 2654435761  # 2**32 / golden ratio
_RANGE = 2**32


def spread_hash(row_id: Column | str, seed: int) -> Column:
    """Row id spread evenly over [0, 2**32); stays inside a bigint."""
    folded = F.pmod(_col(row_id).cast("bigint") + F.lit(seed), F.lit(2**31))
    return F.pmod(folded * F.lit(_MULTIPLIER), F.lit(_RANGE))


def is_test_row(row_id: Column | str, share: float, seed: int) -> Column:
    return spread_hash(row_id, seed) < F.lit(int(share * _RANGE))


def fold_of(row_id: Column | str, folds: int, seed: int) -> Column:
    """Fold 1..folds, from the high bits of the hash."""
    return (
        F.floor(spread_hash(row_id, seed) * F.lit(folds) / F.lit(_RANGE)) + 1
    ).cast("int")

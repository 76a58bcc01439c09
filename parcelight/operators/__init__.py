"""Distributed operators the stages are built from."""

from parcelight.operators.counting import condition_counts, long_form, top_counts
from parcelight.operators.lookup import attach_group_values
from parcelight.operators.numbering import number_rows
from parcelight.operators.quantiles import exact_quantiles
from parcelight.operators.reduce import NULL_KEY, first_by_key, join_key, restore_key
from parcelight.operators.shape import require_columns
from parcelight.operators.sketches import RANK_ERROR, sketch_quantiles, value_sketch

__all__ = [
    "NULL_KEY", "RANK_ERROR", "attach_group_values", "condition_counts", "exact_quantiles",
    "first_by_key", "join_key", "long_form", "number_rows", "require_columns",
    "restore_key", "sketch_quantiles", "top_counts", "value_sketch",
]

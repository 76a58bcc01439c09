"""Column expressions. All are built-in Spark functions, no Python UDF."""

from parcelight.functions.bands import (
    bucket_label,
    signal_score,
    temperature,
    value_tier,
    value_tier_code,
)
from parcelight.functions.numbers import (
    code_prefix,
    number_or_zero,
    parse_number,
    ratio,
    whole_number,
    year_prefix,
    zero_to_null,
    zip5,
)
from parcelight.functions.spread import fold_of, is_test_row, spread_hash
from parcelight.functions.text import missing_to_null, normal_text, strip, zero_pad

__all__ = [
    "bucket_label", "code_prefix", "fold_of", "is_test_row",
    "missing_to_null", "normal_text", "number_or_zero", "parse_number",
    "ratio", "signal_score", "spread_hash", "strip", "temperature",
    "value_tier", "value_tier_code", "whole_number", "year_prefix",
    "zero_pad", "zero_to_null", "zip5",
]

"""Text to number, and arithmetic that tolerates missing values."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelight.functions.text import MISSING_TEXT, _col, strip

# Letters by which Spark's cast reads more than plain decimal or scientific
# notation: type suffixes ('1.5d', '2F') and hexadecimal ('0x1p3').
_NOT_PLAIN = "dDfFxX"
_LARGEST = 1.7976931348623157e308


def parse_number(c: Column | str) -> Column:
    """Text as double, NULL when it is not a finite number. Blanks around the
    number are ignored."""
    c = _col(c)
    number = c.try_cast("double")
    finite = F.abs(number) <= _LARGEST  # false for NaN as well
    # Looking for a byte costs far less than taking letters out of every text.
    plain = reduce(and_, [~F.contains(c, F.lit(letter)) for letter in _NOT_PLAIN])
    return F.when(finite & plain, number)


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(parse_number(c), F.lit(0.0))


def whole_number(c: Column | str) -> Column:
    """As an int; 0 when missing, not a number or out of range."""
    return F.coalesce(_col(c).try_cast("int"), F.lit(0))


def code_prefix(c: Column | str) -> Column:
    """First three characters of a use code ('00100' -> '001')."""
    return F.substring(strip(F.coalesce(_col(c), F.lit(MISSING_TEXT))), 1, 3)


def zip5(c: Column | str) -> Column:
    """Five-digit ZIP of a ZIP or ZIP+4 text, 0 when unusable."""
    return number_or_zero(F.substring(_col(c), 1, 5))


def year_prefix(c: Column | str) -> Column:
    """Year of a date text that starts with four digits, 0 when unusable."""
    return number_or_zero(F.substring(_col(c), 1, 4))


def zero_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, NULL when either side is missing or the divisor is 0."""
    return F.try_divide(_col(numerator), _col(denominator))

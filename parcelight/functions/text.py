"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelight.constants import NA_TOKENS

# ASCII and Unicode white space.
_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
)

# What a missing text value turns into once it is treated as text.
MISSING_TEXT = "nan"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(_BLANKS))


def missing_to_null(c: Column | str) -> Column:
    """NULL for every token that stands for a missing value in a source file."""
    c = _col(c)
    return F.when(~c.isin(*NA_TOKENS), c)


def normal_text(
    c: Column | str, upper: bool = False, strict_nulls: bool = False
) -> Column:
    """Stripped text.

    A missing value becomes the text ``nan``, as it does in the tables this
    library has to agree with; ``strict_nulls`` keeps it NULL instead.
    """
    c = _col(c)
    text = strip(c if strict_nulls else F.coalesce(c, F.lit(MISSING_TEXT)))
    return F.upper(text) if upper else text


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer values are kept whole (``lpad`` cuts them)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)

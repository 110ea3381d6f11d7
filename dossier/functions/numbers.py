"""Numeric and boolean parsing rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _c, strip

# A plain decimal or scientific number with optional surrounding spaces.
# Spark's cast alone would accept '1d' or 'inf'; pandas would not.
NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_double(c: Column | str) -> Column:
    """Numeric text -> double, anything else -> null ('3.8 GPA' -> null)."""
    txt = _c(c).cast("string")
    return F.when(txt.rlike(NUMBER_RE), F.trim(txt).try_cast("double"))


def to_int_or_zero(c: Column | str) -> Column:
    """E5: numeric parse truncated toward zero; bad or null -> 0 (bigint)."""
    return F.coalesce(to_double(c).try_cast("bigint"), F.lit(0).cast("bigint"))


# Spellings Spark's string-to-boolean cast accepts (any case, surrounding whitespace ignored).
BOOL_TEXT = ("t", "true", "y", "yes", "1", "f", "false", "n", "no", "0")


def to_bool(c: Column | str) -> Column:
    """Boolean text or value; anything else or null -> false.

    Only accepted spellings reach the cast, so a column of free text does not
    pay the cast's failure path on every row.
    """
    txt = F.lower(strip(_c(c).cast("string")))
    return F.coalesce(F.when(txt.isin(*BOOL_TEXT), _c(c).try_cast("boolean")), F.lit(False))


def try_cast_fast(c: Column | str, target: T.DataType, source: T.DataType | None = None) -> Column:
    """``try_cast`` with a shortcut: text without a digit is null at once for integral and decimal
    targets (it can never cast), so a drifted text column does not hit the cast's slow failure path."""
    col = _c(c)
    if isinstance(source, T.StringType) and isinstance(target, (T.IntegralType, T.DecimalType)):
        return F.when(col.rlike("[0-9]"), col.try_cast(target))
    return col.try_cast(target)

"""Type-aware column expressions that keep working with ANSI mode on.

Spark 4 raises on ``cast('NA' as int)``; the original job relied on the old
behaviour (malformed text -> NULL). These helpers reproduce that behaviour
with ``try_cast`` and stay inside whole-stage codegen (no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text an integer column accepts: optional sign, digits, optional fraction.
# The fraction is truncated, as the pre-ANSI cast of '360.0' to int did.
INTEGER_TEXT = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_INTEGER_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"   # the same, its first group the part before the fraction

_INTEGRAL = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def guarded_cast(c: Column | str, dtype: T.DataType) -> Column:
    """Cast text to ``dtype``; anything malformed becomes NULL instead of an error."""
    c = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.StringType):
        return c.cast("string")
    if isinstance(dtype, _INTEGRAL):
        text = c.cast("string")
        # Fast path: plain integer text. Only values it rejects (e.g. '360.0',
        # 'NA') pay for the regex that accepts and truncates a fraction; without a match it gives
        # '', which casts to NULL. One regex, for this expression is copied into every pushed-down filter.
        return F.coalesce(text.try_cast(dtype), F.regexp_extract(text, _INTEGER_PART, 1).try_cast(dtype))
    if isinstance(dtype, _FRACTIONAL):
        return c.cast("string").try_cast(T.DoubleType()).cast(dtype)
    return c.try_cast(dtype)


def is_float_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FRACTIONAL)


def is_string_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def missing_flag(c: str, dtype: T.DataType, nan: bool = True,
                 sentinel: str | None = "NA") -> Column:
    """NULL, NaN (float columns only) or the text sentinel (string columns only).

    ``isnan`` on a string and ``int == 'NA'`` both fail under ANSI, so each
    test is applied only where the column's type allows it.
    """
    flag = F.col(c).isNull()
    if nan and is_float_type(dtype):
        flag = flag | F.isnan(F.col(c))
    if sentinel is not None and is_string_type(dtype):
        flag = flag | (F.col(c) == F.lit(sentinel))
    return flag


def value_or_null(c: str, dtype: T.DataType) -> Column:
    """The column with NaN turned into NULL (float columns), else unchanged."""
    if is_float_type(dtype):
        return F.nanvl(F.col(c), F.lit(None).cast(dtype))
    return F.col(c)

"""Lenient typing and text normalisation as Column expressions.

Spark 4 runs with ANSI mode on, where ``cast`` raises on bad text.  The
Silver layer wants the old lenient behaviour (bad text -> NULL), so every
cast here is a ``try_cast``.  ``lenient_int`` also reproduces the non-ANSI
``'12.5' -> 12`` truncation for plain decimal text, but not for exponent
forms such as ``'1e2'`` (the non-ANSI cast gives NULL there).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal number text: optional sign, digits, optional fraction.
_DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def norm_text(col) -> Column:
    """``lower(trim(x))`` -- the Silver normalisation of categorical text."""
    return F.lower(F.trim(_c(col)))


def lenient_double(col) -> Column:
    """Text to double; unparsable text becomes NULL instead of an error."""
    return _c(col).try_cast("double")


def lenient_int(col, truncate_decimals: bool = True) -> Column:
    """Text to int; ``'12.5'`` -> 12 like the non-ANSI cast, junk -> NULL."""
    c = _c(col)
    if not truncate_decimals:
        return c.try_cast("int")
    via_decimal = c.try_cast("decimal(38,18)").try_cast("int")
    return F.when(c.rlike(_DECIMAL_TEXT), via_decimal)


def yes_label(col, positive: str = "yes") -> Column:
    """Label encode: ``positive`` (after normalisation) -> 1, anything else, NULL included -> 0."""
    return F.when(norm_text(col) == positive, F.lit(1)).otherwise(F.lit(0))


def blank_or_null(col) -> Column:
    """True for NULL or whitespace-only text; never NULL itself."""
    c = _c(col)
    return c.isNull() | (F.trim(c) == "")

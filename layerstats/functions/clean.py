"""Column expressions that turn dirty text into typed values.

Built-in functions only, so they stay inside whole-stage code generation, and
safe under ANSI mode, where a plain cast of bad text aborts the job.

``try_cast`` yields NULL for bad text but gets there by throwing and catching
an exception per value, which costs far more than the regular expression in
front of it. Blank cells are the common bad value in statistics files, so every
cast here is fed NULL, not blank text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns.
NON_DIGIT = "[^0-9]"
PERCENT = "%"

# Optional sign and digits, then an optional fraction, which is cut off. The
# outer class is what a cast to a number ignores around the digits.
INTEGER_TEXT = r"^[\s\p{Cntrl}]*([+-]?[0-9]+)(?:\.[0-9]*)?[\s\p{Cntrl}]*$"


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _unless_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def keep_digits(column: Column | str) -> Column:
    """Drop everything but ASCII digits: ``-5`` -> ``5``, ``1.234`` -> ``1234``."""
    return F.regexp_replace(_text(column), NON_DIGIT, "")


def drop_percent(column: Column | str) -> Column:
    """Drop percent signs: ``61%`` -> ``61``."""
    return F.replace(_text(column), F.lit(PERCENT), F.lit(""))


def integer_text(column: Column | str) -> Column:
    """Read text as int; a fraction is cut off, anything unreadable is NULL."""
    return _unless_blank(F.regexp_extract(_text(column), INTEGER_TEXT, 1)).try_cast("int")


def count_value(column: Column | str, default: int = 0) -> Column:
    """Digits of the text as int; ``default`` where there are none or too many."""
    return F.coalesce(_unless_blank(keep_digits(column)).try_cast("int"), F.lit(default).cast("int"))


def percent_value(column: Column | str, default: float = 0.0) -> Column:
    """Percent text as double; ``default`` where it is no number."""
    return F.coalesce(
        _unless_blank(drop_percent(column)).try_cast("double"), F.lit(default).cast("double")
    )


def strict_int_value(column: Column | str, default: int = 0) -> Column:
    """Like :func:`count_value`, but text is read as it stands: ``-5`` stays -5."""
    return F.coalesce(integer_text(column), F.lit(default).cast("int"))


def strict_double_value(column: Column | str, default: float = 0.0) -> Column:
    """Text read as double as it stands; ``61%`` becomes ``default``."""
    return F.coalesce(
        _unless_blank(_text(column)).try_cast("double"), F.lit(default).cast("double")
    )

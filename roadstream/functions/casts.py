"""Casts that give NULL for a bad value, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that a non-ANSI string-to-int cast reads by dropping its fraction.
_BLANK = r"[\s\p{Cntrl}]*"
_FRACTIONAL = rf"^{_BLANK}(?<sign>[+-]?)(?<whole>[0-9]*)[.][0-9]*{_BLANK}$"


def lenient_int(text: Column) -> Column:
    """Integer part of ``text`` as a non-ANSI cast reads it; NULL when it is not a number.

    Plain integers take the first branch; the pattern runs only on what it could not read.
    """
    whole = F.regexp_replace(text, _FRACTIONAL, "${sign}0${whole}")
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"))


def lenient_timestamp(text: Column) -> Column:
    """ISO-8601 ``text`` as a timestamp; NULL when malformed."""
    return F.try_to_timestamp(text)

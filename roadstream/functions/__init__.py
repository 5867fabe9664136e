"""Column-level helpers."""

from roadstream.functions.casts import lenient_int, lenient_timestamp
from roadstream.functions.rules import first_match

__all__ = ["first_match", "lenient_int", "lenient_timestamp"]

"""Ordered rules as one CASE expression."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first rule whose condition holds, else ``default``.

    A condition that is NULL does not hold, as in SQL CASE.
    """
    case = reduce(lambda chain, rule: chain.when(*rule), rules, F)
    return case.otherwise(default)

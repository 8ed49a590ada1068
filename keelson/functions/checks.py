"""Data-quality predicates used by the checks in ``operators.quality``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a gear code is valid when it is an optionally negative integer.
NUMERIC_PATTERN = "^-?[0-9]+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_not_numeric(c: str | Column, pattern: str = NUMERIC_PATTERN) -> Column:
    """True when the value does not match ``pattern``; null when it is null."""
    return ~_col(c).rlike(pattern)


def is_untrimmed(c: str | Column) -> Column:
    """True when trimming spaces would change the value; null when null."""
    col = _col(c)
    return F.trim(col) != col

"""Numeric parsing and safe arithmetic on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number with optional exponent.  Spark's cast also accepts
# ' 5 ' and '1d', which aren't counters, so guard first; infinities are left out too.
NUMERIC_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_double(c) -> Column:
    """Text -> DOUBLE, NULL unless the whole text is a plain number."""
    c = _c(c)
    return F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double"))


def counter(c) -> Column:
    """Counter text -> DOUBLE where a missing or non-numeric counter reads as 0."""
    return F.coalesce(parse_double(c), F.lit(0.0))


def mb(c, places: int | None = None) -> Column:
    """Bytes -> MiB (DOUBLE), optionally rounded."""
    v = _c(c).cast("double") / F.lit(1048576.0)
    return F.round(v, places) if places is not None else v

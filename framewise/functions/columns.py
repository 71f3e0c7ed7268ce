"""Scalar column expressions shared by the operators.

All of these compile to Catalyst expressions, so they stay inside whole-stage
codegen and are pushed through projections like any built-in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewise.schemas import DAY, NIGHT


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def time_of_day(timing="timing") -> Column:
    """``Day`` when the lower-cased timing text contains "day", else ``Night``.

    A null timing is ``Night`` and "Monday" is ``Day``: the test is a plain
    substring match, never null.
    """
    return F.when(F.lower(_c(timing)).contains("day"), F.lit(DAY)).otherwise(F.lit(NIGHT))


def flag_as_int(col) -> Column:
    """Per-frame flag as int; text that is not a number becomes null, not an error."""
    return F.expr(f"try_cast(`{col}` AS INT)") if isinstance(col, str) else col.try_cast("int")


def not_true(col) -> Column:
    """True for false, null and missing values: a null-safe ``!= true``."""
    return ~_c(col).eqNullSafe(F.lit(True))


def basename(path) -> Column:
    """Last path segment of a '/'-separated path or URL."""
    return F.element_at(F.split(_c(path), "/"), -1)


def round6(col) -> Column:
    return F.round(_c(col).cast("double"), 6)

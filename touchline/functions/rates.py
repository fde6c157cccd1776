"""Small column expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """1 where ``condition`` holds, 0 where it is false or NULL, so that sums of it count."""
    return F.when(condition, 1).otherwise(0)


def share(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole`` as a double, NULL for an empty whole.

    ``digits`` rounds it. Sums of doubles depend on the order of addition; rounding makes equal
    ratios tie in a later ranking whatever that order was.
    """
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def change(now: Column, before: Column) -> Column:
    """Relative change; NULL without a predecessor, or when that was zero."""
    return share(now - before, before)

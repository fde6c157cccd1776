"""Joins of events to their dimensions and to each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def with_match(df: DataFrame, matches: DataFrame, columns: Sequence[str], key: str = "match_id") -> DataFrame:
    """Add ``columns`` of the match (``key`` is unique in ``matches``). Rows without a match vanish."""
    return df.join(matches.select(key, *columns), key)


def with_competition(
    matches: DataFrame,
    competitions: DataFrame,
    columns: Sequence[str],
    key: Sequence[str] = ("competition_id", "season_id"),
) -> DataFrame:
    """Add ``columns`` of the competition and season a match belongs to.

    This joins dimension to dimension, before any event is touched.
    """
    return matches.join(competitions.select(*key, *columns), list(key))


def linked_pairs(df: DataFrame, other: DataFrame, reference: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``reference`` names a row of ``other`` by its unique ``key``.

    Filter and project both sides first. One row of ``other`` can be named any number of times: the
    adaptive skew join then splits the side of ``df``, as the other side has one row to copy.
    """
    return df.join(other, F.col(reference) == F.col(key))

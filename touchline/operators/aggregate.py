"""Grouped counts, means and rates, and the global top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.functions.rates import flag, share


def count_by(df: DataFrame, by: Sequence[str], name: str = "n", where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.where(where)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def mean_by(
    df: DataFrame, by: Sequence[str], value: str | Column, name: str = "mean", where: Column | None = None
) -> DataFrame:
    """Mean of ``value`` by group. Rows without a value count for nothing, nor do they make a group."""
    value = F.col(value) if isinstance(value, str) else value
    rows = df.where(value.isNotNull() if where is None else where & value.isNotNull())
    return rows.groupBy(*by).agg(F.avg(value).alias(name))


def completion_rate(
    df: DataFrame,
    by: Sequence[str],
    success: Column,
    where: Column | None = None,
    names: tuple[str, str, str] = ("total", "successful", "rate"),
) -> DataFrame:
    """Rows, successful rows and their ratio by group."""
    total, successful, rate = names
    rows = df if where is None else df.where(where)
    counts = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias(total), F.sum(flag(success)).alias(successful)
    )
    return counts.withColumn(rate, share(F.col(successful), F.col(total)))


def sum_through(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    own: Sequence[str],
    theirs: Sequence[str],
    fold: bool = True,
    **sums: Column,
) -> DataFrame:
    """Sums by columns of ``facts`` (``own``) and of the dimension joined on ``key`` (``theirs``).

    ``fold`` sums the facts by (key, own) before the join, and again after it. The join then moves
    one row per group, not one per fact, and a key that holds a third of the facts has been folded up
    by the tasks that read them. Without ``own`` columns this costs no shuffle beyond the join's.

    ``fold=False`` is for groups so fine that folding would hardly shrink them, and would shuffle them
    once more. Only the summed columns move then, once; the dimension has one row per key, so the
    adaptive join can split a hot key's facts.
    """
    names = list(sums)
    rows = facts.select(key, *own, *[value.alias(name) for name, value in sums.items()])
    if fold:
        rows = rows.groupBy(key, *own).agg(*[F.sum(name).alias(name) for name in names])
    joined = rows.join(dimension.select(key, *theirs), key)
    return joined.groupBy(*own, *theirs).agg(*[F.sum(name).alias(name) for name in names])


def diff_from_mean(
    df: DataFrame, value: str, mean_name: str = "mean", diff_name: str = "diff"
) -> DataFrame:
    """Each row's ``value`` against the mean over all rows.

    The mean is a scalar subquery: one number, no join, no trip through the driver's Python, and
    the shuffle below ``df`` is shared by both uses.
    """
    mean = df.agg(F.avg(value)).scalar()
    return df.withColumn(mean_name, mean).withColumn(diff_name, F.col(value) - F.col(mean_name))


def top_n(df: DataFrame, value: str, tie: Sequence[str], n: int = 10, name: str = "rank") -> DataFrame:
    """The ``n`` rows with the largest ``value``, numbered from 1; ties go by the ``tie`` columns.

    The limit comes first, so each task keeps n rows and the number is given to n rows in all.
    """
    order = [F.col(value).desc(), *[F.col(c).asc() for c in tie]]
    return (
        df.orderBy(*order)
        .limit(n)
        .withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
        .orderBy(name)
    )

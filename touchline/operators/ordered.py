"""Ordered groups of any size, without one of them filling a task.

A window function sends each group to one task. That is right for ordinary groups, but a team, pair
or season holding a third of all rows would make that task the whole job. So the rows are written
once, the groups counted, and only those beyond a limit are taken apart.

Large groups are range-partitioned by (group, order), and the number of the range is kept as a chunk.
The window functions then run by (group, chunk), and what crosses a chunk border is mended apart.
Chunks are contiguous, so each has at most two groups that reach beyond it, its first and its last.
Whatever the data looks like, a table of those groups has at most two rows per chunk, and may be
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.session import pin

CHUNK = "_chunk"
# A group of up to this many rows goes to one task as it is, a matter of seconds.
GROUP_LIMIT = 1_000_000
# Nor is a group taken apart below this part of a partition's fair share of the rows.
FAIR_PART = 1 / 8


def by_size(
    df: DataFrame,
    by: Sequence[str],
    whole: Callable[[DataFrame], DataFrame],
    chunked: Callable[[DataFrame], DataFrame],
    bounded: bool = False,
) -> DataFrame:
    """``whole`` over the rows of ordinary groups, together with ``chunked`` over those of large ones.

    Both must give one schema and one value for a row, so that the limit chooses a plan and nothing
    else. Where all groups are known to be ordinary (``bounded``), nothing is written or counted.
    """
    if bounded:
        return whole(df)
    rows = pin(df)
    large = large_groups(rows, by)
    if large is None:
        return whole(rows)
    return whole(_pick(rows, large, by, "left_anti")).unionByName(
        chunked(_pick(rows, large, by, "left_semi"))
    )


def large_groups(rows: DataFrame, by: Sequence[str]) -> DataFrame | None:
    """Of pinned rows, the groups beyond the limit, None if there are none.

    Each holds more than a given part of all rows, so their number is below the inverse of that part
    however large the data is: they can pass through the driver and be broadcast.
    """
    spark = rows.sparkSession
    part = FAIR_PART / int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    total = sizes.agg(F.sum("_rows")).scalar()
    large = sizes.where(F.col("_rows") > F.greatest(F.lit(float(GROUP_LIMIT)), total * part)).select(*by)
    keys = large.collect()
    return spark.createDataFrame(keys, large.schema) if keys else None


def split(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with its chunk numbers, written once.

    The order should be total within a group, or rows that tie cannot be told apart. The copy is
    pinned because range bounds are sampled: two evaluations could cut at different places.
    """
    ranges = df.repartitionByRange(*[F.col(c).asc() for c in by], *order)
    return pin(ranges.withColumn(CHUNK, F.spark_partition_id()))


def spread(rows: DataFrame) -> DataFrame:
    """Each chunk a partition of its own, as windows by (group, chunk) want it.

    Left to hash, a few chunks would meet in one partition, and AQE would merge them further where
    sorted values compress well.
    """
    return rows.repartitionById(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), CHUNK)


def spanning(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """The (group, chunk) pairs of groups with rows in more than one chunk.

    Found from the first and last group of each chunk. The windows have no partition, but they see
    one row per chunk.
    """
    group = F.struct(*by)
    chunks = rows.groupBy(CHUNK).agg(F.min(group).alias("_first"), F.max(group).alias("_last"))
    order = Window.orderBy(CHUNK)
    came_in = F.col("_first") == F.lag("_last").over(order)
    goes_on = F.col("_last") == F.lead("_first").over(order)
    ends = F.array_compact(
        F.array(F.when(F.col("_came_in"), F.col("_first")), F.when(F.col("_goes_on"), F.col("_last")))
    )
    return (
        chunks.withColumns({"_came_in": came_in, "_goes_on": goes_on})
        .select(CHUNK, F.explode(F.array_distinct(ends)).alias("_group"))
        .select(CHUNK, "_group.*")
    )


def attach(rows: DataFrame, summary: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    """Join what is known of the spanning groups, by (group, chunk)."""
    return _pick(rows, summary, [*by, CHUNK], how)


def _pick(rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a table of bounded size. NULL keys match each other."""
    right = small.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    return rows.join(F.broadcast(right), same, how).drop(*[f"_r_{c}" for c in keys])

"""Mixing of sources to target weights by Pfair scheduling, on DataFrame functions alone.

Documents of a source are put in an order that does not depend on how they are stored and cut into
blocks of equal size. Weights are exact ratios, ``units`` of ``PERIOD`` ticks, so block i of a source has
release ``floor(i * PERIOD / units)`` and deadline ``ceil((i + 1) * PERIOD / units)``. Each tick takes,
of the released blocks, that of the earliest deadline. As the units sum to the period, every block
runs within its window, so at no tick is a source a whole block ahead of its share or behind it. Where a
source ends, the windows of the others begin anew, by their shares of one another.

The schedule of all blocks, not of the documents, is worked out on the driver, some microseconds a
block, and written to the shared folder in parts; a document finds its tick by its source and block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from heapq import heappop, heappush
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from touchline.session import scratch

PERIOD = 1 << 40
"""Ticks of which weights are whole parts; over a billion ticks the rounding is below a thousandth of a block."""
BLOCK = 8
"""Documents in a block."""
BUCKET = 4096
"""Documents of a source that are put in order in one task, about."""
PART = 1 << 18
"""Blocks of the schedule that the driver holds at once."""
BROADCAST_ROWS = 500_000


def tempered(docs: DataFrame, power: float = 0.5, source: str = "source") -> DataFrame:
    """Target weights that favour small sources: a source's number of documents to ``power``.

    One row per source with ``source`` and ``weight``; a null source is a source of its own.
    """
    counts = docs.groupBy(F.col(source).alias("source")).count()
    return counts.select("source", F.pow("count", F.lit(power)).alias("weight"))


def _parts(weights: dict, period: int) -> dict:
    """Whole numbers of at least 1 that sum to ``period``, in proportion to ``weights``, by largest remainder.

    Only where a proportion is below 1 does its source get more than that, and the others share the rest.
    """
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources need a period of as many ticks, not {period}")
    exact = {s: Fraction(w) for s, w in weights.items()}
    order = sorted(exact, key=lambda s: (exact[s], s is not None, s))
    left, total, out = period, sum(exact.values()), {}
    while order and exact[order[0]] * left < total:
        least = order.pop(0)
        out[least], left, total = 1, left - 1, total - exact[least]
    share = {s: exact[s] * left / total for s in order}
    out |= {s: math.floor(x) for s, x in share.items()}
    by_rest = sorted(order, key=lambda s: (out[s] - share[s], s is not None, s))
    for s in by_rest[:left - sum(out[x] for x in order)]:
        out[s] += 1
    return out


def _weights(targets: DataFrame, source: Column) -> dict:
    """The positive weights, by source; a row per source comes to the driver."""
    weighed = targets.where("weight > 0").groupBy(source.alias("s")).agg(F.sum("weight").cast("double").alias("w"))
    return {r["s"]: r["w"] for r in weighed.collect()}


def units(targets: DataFrame, period: int = PERIOD) -> DataFrame:
    """``targets`` with ``units`` of a period that sum to it: in proportion, by largest remainder, at least 1.

    Sources without a positive weight get no row. It needs no more sources than ticks in a period.
    """
    weights = _weights(targets, F.col("source"))
    kind = targets.schema["source"].dataType.simpleString()
    rows = [(s, weights[s], n) for s, n in _parts(weights, period).items()]
    return targets.sparkSession.createDataFrame(rows, f"source {kind}, weight double, units long")


def _edf(parts: list[int], sizes: list[float]) -> Iterator[tuple[int, int, int, int, int]]:
    """Source, block, tick, release and deadline of every block, in the order of the ticks.

    Source i has ``sizes[i]`` blocks and ``parts[i]`` of the sum of the parts. Earliest deadline first; ties go to the
    source that comes first. Ticks of a source of no blocks stay empty until the first of the others ends.
    """
    done, tick, active = [0] * len(parts), 0, list(range(len(parts)))
    while any(sizes[i] for i in active):
        base, total, ended = tick, sum(parts[i] for i in active), False
        begun = {i: done[i] for i in active}
        waiting, ready = [(base, i) for i in active], []
        while not ended:
            while waiting and waiting[0][0] <= tick:
                release, i = heappop(waiting)
                deadline = base - (-(done[i] - begun[i] + 1) * total // parts[i])
                heappush(ready, (deadline, i, release))
            deadline, i, release = heappop(ready)
            if sizes[i]:
                yield i, done[i], tick, release, deadline
            done[i] += 1
            ended = done[i] == sizes[i]
            heappush(waiting, (base + (done[i] - begun[i]) * total // parts[i], i))
            tick += 1
        active = [i for i in active if done[i] < sizes[i]]


def schedule(shares: DataFrame, period: int = PERIOD) -> DataFrame:
    """One period: ``source``, ``place`` (the block's number in the period, from 0) and ``tick``.

    ``shares`` has ``source`` and ``units`` that sum to ``period``. Earliest deadline first; ties go to
    the source with more units, then the smaller name, null first.
    """
    rows = sorted(shares.select("source", "units").collect(), key=lambda r: (-r[1], r[0] is not None, r[0]))
    ran = islice(_edf([r[1] for r in rows], [math.inf] * len(rows)), period if rows else 0)
    kind = shares.schema["source"].dataType.simpleString()
    named = [(rows[i][0], place, tick) for i, place, tick, _, _ in ran]
    return shares.sparkSession.createDataFrame(named, f"source {kind}, place long, tick long")


def _key(source: str) -> Column:
    """A source's name as text that is never null, so that joins can take it as it is."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def blocks(docs: DataFrame, counts: DataFrame, id_: str, block: int = BLOCK) -> DataFrame:
    """``docs``, which have a source's ``_key``, with ``_block``: the number of its block there, from 0.

    ``counts`` has a row per ``_key`` with its documents ``_n``. The order in a source is that of the
    id's MD5, then the id. It is cut by the digest's first 32 bits into buckets of about ``BUCKET``
    documents, so that a large source is ordered by many tasks; the sizes of the buckets before tell
    where each begins.
    """
    digest = F.md5(F.coalesce(F.col(id_).cast("string"), F.lit("")))
    start = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long")
    bucket = F.shiftright(start * F.ceil(F.col("_n") / BUCKET), 32)
    keyed = docs.withColumn("_digest", digest).join(counts, "_key").withColumn("_bucket", bucket).drop("_n")
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("_key", "_bucket").agg(F.count("*").alias("_size"))
    sizes = sizes.select("_key", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    # The join needs the rows dealt as the window does, so it adds no shuffle of the documents.
    within = F.row_number().over(Window.partitionBy("_key", "_bucket").orderBy("_digest", id_))
    placed = keyed.withColumn("_within", within).join(sizes, ["_key", "_bucket"])
    number = F.floor((F.col("_before") + F.col("_within") - 1) / block)
    return placed.withColumn("_block", number).drop("_digest", "_bucket", "_within", "_before")


_TICKS = ["_s", "_block", "_tick", "_release", "_deadline"]


def _ticks(spark: SparkSession, ran: Iterator[tuple]) -> DataFrame:
    """What ``_edf`` yields, as rows in the shared folder."""
    path = scratch(spark, "ticks")
    kinds = pa.schema([(c, pa.int64()) for c in _TICKS])
    first = True
    while (part := list(islice(ran, PART))) or first:
        columns = zip(*part) if part else [[]] * len(_TICKS)
        table = pa.table([pa.array(c, pa.int64()) for c in columns], schema=kinds)
        spark.createDataFrame(table).write.mode("append").parquet(path)
        first = False
    return spark.read.schema(", ".join(f"{c} long" for c in _TICKS)).parquet(path)


def mix(
    docs: DataFrame, targets: DataFrame | None = None, least: float = 0.5, source: str = "source",
    id_: str = "doc_id", block: int = BLOCK, period: int = PERIOD,
) -> DataFrame:
    """``docs`` with ``block``, ``release``, ``deadline`` and ``tick`` of each document's block, and ``used``.

    ``targets`` has ``source`` and ``weight``; without it ``tempered`` gives them, as whole parts of ``period``.
    Where a source runs out, the others go on to their ends by their shares of one another. Until the first
    one has, every source is within one block of its share at every tick; from each end to the next, so
    are those that are left, counted from that end. Ticks of a source without documents stay empty until the
    first end. Documents after the last tick at which sources of ``least`` of the target weight still have
    blocks have ``used`` false, as have those of sources without a weight, whose other columns are null.

    A null source is a source like any other. Documents with a null id come first in the order of an
    empty one; repeated rows are documents of their own. Columns of these names in ``docs`` give way.
    """
    spark = docs.sparkSession
    named = ("block", "release", "deadline", "tick", "used")
    kept = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in named])
    counted = {r[0]: r[1] for r in docs.groupBy(_key(source)).count().collect()}
    if len(counted) > period:
        raise ValueError(f"{len(counted)} sources need a period of as many ticks, not {period}")
    if targets is None:
        targets = tempered(docs, source=source)
    weights = _weights(targets, _key("source"))
    parts = _parts(weights, period)
    order = sorted(parts, key=lambda s: (-parts[s], s))
    sizes = [-(-counted.get(s, 0) // block) for s in order]
    left, end = sum(parts[s] for s, n in zip(order, sizes) if n), 0

    def followed() -> Iterator[tuple]:
        nonlocal left, end
        for row in _edf([parts[s] for s in order], sizes):
            if left >= least * period:
                end = row[2] + 1
            if row[1] + 1 == sizes[row[0]]:
                left -= parts[order[row[0]]]
            yield row

    ticks = _ticks(spark, followed())
    if sum(sizes) <= BROADCAST_ROWS:
        ticks = F.broadcast(ticks)
    place = {s: i for i, s in enumerate(order)}
    counts = spark.createDataFrame(pa.table({
        "_key": pa.array(list(counted), pa.string()), "_n": pa.array(list(counted.values()), pa.int64()),
        "_s": pa.array([place.get(s) for s in counted], pa.int64()),
    }))
    placed = blocks(kept.withColumn("_key", _key(source)), F.broadcast(counts), id_, block)
    placed = placed.join(ticks, ["_s", "_block"], "left")
    return placed.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        F.when(F.col("_tick").isNotNull(), F.col("_block")).alias("block"),
        F.col("_release").alias("release"), F.col("_deadline").alias("deadline"), F.col("_tick").alias("tick"),
        F.coalesce(F.col("_tick") < end, F.lit(False)).alias("used"),
    )

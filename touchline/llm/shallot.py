"""Centroid clustering in whole numbers, by shallot search.

Vectors travel in blocks, beside them the nearest centroid, the second nearest, and bounds of both
distances. When centroids have moved, the bounds follow by the triangle inequality, and a vector whose
upper bound stays below what any other centroid can reach keeps its own. Of the rest both remembered
centroids are measured, and the search starts from the closer one: its neighbours are tried in the
order of their distance to it, within a ball that shrinks with every second-nearest found. Bounds are
doubles with slack; whatever they leave open is compared in whole numbers, so ties come out exactly.

A pass reads the blocks of the pass before and writes its own, together with the partial sums of each
task: no vector is shuffled, and the driver sees centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.topk import _matrix, _usable as finite
from touchline.session import pin, unpin

BLOCK = 2048
"""Vectors in a block."""
LARGEST = float(1 << 60)
"""Squared length of a vector up to which every squared distance fits a long."""
SLACK = 1e-9

_STATE = pa.schema([
    ("ids", pa.list_(pa.int64())), ("x", pa.binary()), ("first", pa.binary()), ("second", pa.binary()),
    ("upper", pa.binary()), ("lower", pa.binary()),
    ("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64())),
])
_STATE_DDL = (
    "ids array<long>, x binary, first binary, second binary, upper binary, lower binary, "
    "cluster int, n long, sums array<long>"
)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances row by row, exact in 64 bits."""
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class Centres:
    """Centroids with what a search among them needs; ``before`` are those of the pass before."""

    c: np.ndarray
    before: np.ndarray | None = None

    def __post_init__(self):
        k = len(self.c)
        gap = np.stack([squared(self.c, row) for row in self.c]) if k else np.zeros((0, 0), np.int64)
        self.gap = np.sqrt(gap.astype(np.float64))
        # Each one's neighbours from near to far, itself first even where another lies on it.
        at_self = self.gap.copy()
        np.fill_diagonal(at_self, -1)
        self.order = np.argsort(at_self, axis=1, kind="stable")
        # Nothing closer than half the way to the nearest other centroid can belong to another.
        self.half = self.gap[np.arange(k), self.order[:, 1]] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if self.before is None else np.sqrt(squared(self.c, self.before).astype(np.float64))
        self.moved = moved * (1 + SLACK)
        # The furthest that any centroid but one's own has moved.
        top = int(np.argmax(self.moved)) if k else 0
        others = np.full(k, self.moved.max(initial=0))
        if k:
            others[top] = np.delete(self.moved, top).max(initial=0)
        self.others = others


@dataclass
class State:
    """Of each vector of a block: nearest and second-nearest centroid, and bounds of their distances.

    ``upper`` is no less than the distance to ``first``; ``lower`` no more than that to any other.
    """

    first: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray


def start(x: np.ndarray, at: Centres) -> State:
    """All centroids measured, for vectors of which nothing is known."""
    n, k = len(x), len(at.c)
    first, second = np.zeros(n, np.int32), np.full(n, min(1, k - 1), np.int32)
    if k == 1:
        return State(first, second, np.sqrt(squared(x, at.c[first]).astype(np.float64)), np.full(n, np.inf))
    all_ = np.stack([squared(x, c) for c in at.c], axis=1)
    first = np.argmin(all_, axis=1).astype(np.int32)
    row = np.arange(n)
    near = all_[row, first].copy()
    all_[row, first] = np.iinfo(np.int64).max
    second = np.argmin(all_, axis=1).astype(np.int32)
    return State(first, second, np.sqrt(near.astype(np.float64)), np.sqrt(all_[row, second].astype(np.float64)))


def follow(x: np.ndarray, old: State, at: Centres) -> tuple[State, int]:
    """The state under moved centroids, and how many vectors were searched for."""
    first, second = old.first.copy(), old.second.copy()
    upper, lower = old.upper + at.moved[first], old.lower - at.others[first]
    reach = np.maximum(lower, at.half[first]) * (1 - SLACK)
    open_ = np.flatnonzero(upper * (1 + SLACK) >= reach)
    near = squared(x[open_], at.c[first[open_]])
    upper[open_] = np.sqrt(near.astype(np.float64))
    still = upper[open_] * (1 + SLACK) >= reach[open_]
    open_, near = open_[still], near[still]
    if len(at.c) > 1 and len(open_):
        a, b, da, db = search(x[open_], first[open_], second[open_], near, at)
        first[open_], second[open_] = a, b
        upper[open_], lower[open_] = np.sqrt(da.astype(np.float64)), np.sqrt(db.astype(np.float64))
    return State(first, second, upper, lower), len(open_)


def search(x: np.ndarray, a: np.ndarray, b: np.ndarray, da: np.ndarray, at: Centres):
    """Nearest and second-nearest centroid with their squared distances; ties go to the smaller number."""
    db = squared(x, at.c[b])
    closer = (db < da) | ((db == da) & (b < a))
    a, b = np.where(closer, b, a), np.where(closer, a, b)
    da, db = np.where(closer, db, da), np.where(closer, da, db)
    centre, away = a.copy(), np.sqrt(da.astype(np.float64))
    live = np.arange(len(x))
    for place in range(1, len(at.c)):
        j = at.order[centre[live], place]
        ball = (away[live] + np.sqrt(db[live].astype(np.float64))) * (1 + SLACK)
        inside = at.gap[centre[live], j] <= ball
        live, j = live[inside], j[inside]
        if not len(live):
            break
        d = squared(x[live], at.c[j])
        best = (d < da[live]) | ((d == da[live]) & (j < a[live]))
        next_ = ~best & ((d < db[live]) | ((d == db[live]) & (j < b[live])))
        won = live[best]
        b[won], db[won] = a[won], da[won]
        a[won], da[won] = j[best], d[best]
        runner = live[next_]
        b[runner], db[runner] = j[next_], d[next_]
    return a, b, da, db


class _Sums:
    """Partial sums of one task, by cluster."""

    def __init__(self, k: int, dims: int):
        self.n, self.sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)

    def add(self, x: np.ndarray, cluster: np.ndarray) -> None:
        self.n += np.bincount(cluster, minlength=len(self.n))
        order = np.argsort(cluster, kind="stable")
        there, at = np.unique(cluster[order], return_index=True)
        if len(there):
            self.sums[there] += np.add.reduceat(x[order], at, axis=0)

    def batch(self) -> pa.RecordBatch:
        there = np.flatnonzero(self.n)
        none = [None] * len(there)
        return pa.RecordBatch.from_arrays([
            *[pa.array(none, f.type) for f in list(_STATE)[:6]],
            pa.array(there, pa.int32()), pa.array(self.n[there]), pa.array(self.sums[there].tolist(), pa.list_(pa.int64())),
        ], schema=_STATE)


def _block(ids: pa.Array, x: np.ndarray, state: State) -> pa.RecordBatch:
    offsets = pa.array([0, len(ids)], pa.int32())
    parts = [x.astype(np.int32), state.first, state.second, state.upper, state.lower]
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(offsets, ids), *[pa.array([p.tobytes()], pa.binary()) for p in parts],
         pa.array([None], pa.int32()), pa.array([None], pa.int64()), pa.array([None], pa.list_(pa.int64()))],
        schema=_STATE,
    )


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray, State]]:
    """Ids, vectors and states of the blocks that a task reads."""
    for batch in batches:
        for i in range(batch.num_rows):
            x, first, second, upper, lower = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                for c, kind in zip(range(1, 6), (np.int32, np.int32, np.int32, np.float64, np.float64), strict=True)
            )
            yield batch.column(0)[i].values, x.astype(np.int64).reshape(-1, dims), State(first, second, upper, lower)


def _first_pass(centres: Centres) -> Callable:
    k, dims = centres.c.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dims)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(pa.chunked_array([part.column(1)]), dims).astype(np.int64)
                state = start(x, centres)
                sums.add(x, state.first)
                yield _block(part.column(0), x, state)
        yield sums.batch()

    return run


def _next_pass(centres: Centres) -> Callable:
    k, dims = centres.c.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dims)
        for ids, x, state in _blocks(batches, dims):
            state, _ = follow(x, state, centres)
            sums.add(x, state.first)
            yield _block(ids, x, state)
        yield sums.batch()

    return run


def _last_pass(centres: Centres) -> Callable:
    dims = centres.c.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, state in _blocks(batches, dims):
            state, _ = follow(x, state, centres)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(state.first, pa.int32()), pa.array(squared(x, centres.c[state.first]))],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def _held(table: DataFrame) -> DataFrame:
    """The blocks of a pass without its sums."""
    return table.where(F.col("ids").isNotNull()).select("ids", "x", "first", "second", "upper", "lower")


def _means(table: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Exact means rounded down; centroids without vectors stay. The driver gets one row per cluster and dimension."""
    partial = table.where(F.col("cluster").isNotNull()).select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    after = centres.copy()
    for row in partial.groupBy("cluster", "dim").agg(exact("n"), exact("s")).collect():
        after[row.cluster, row.dim] = int(row.s) // int(row.n)
    return after


@dataclass
class Clusters:
    """``members``: ``vec_id``, ``cluster`` and ``distance`` per vector. ``centroids``: the final ones, in order."""

    members: DataFrame
    centroids: np.ndarray


def usable(vectors: DataFrame, scale: int, dims: int, id_: str, vector: str) -> DataFrame:
    """``id`` and ``x``, the components times ``scale`` rounded down, of the vectors that take part."""
    given = F.col(vector)
    whole = F.transform(given, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    rows = vectors.where(finite(given) & (F.size(given) == dims)).select(F.col(id_).cast("long").alias("id"), whole.alias("x"))
    return rows.where(F.aggregate("x", F.lit(0.0), lambda total, c: total + c * c) <= LARGEST)


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dims: int = 64, seed: str = "2",
    id_: str = "vec_id", vector: str = "embedding",
) -> Clusters:
    """``k`` clusters after ``rounds`` of assignment and update and one last assignment.

    A vector takes part if it has exactly ``dims`` components, none null or non-finite; components count as
    whole numbers, times ``scale`` rounded down. Vectors longer than 2^30 in these units are left out, since a
    long could not hold their distances. Centroids start as the vectors with the smallest
    SHA-256 of ``seed:id``; fewer vectors make fewer centroids. Repeated rows count as often as they are there,
    and of rows that repeat an id the one with the smaller vector starts first. A null id stays null, and is
    hashed as the empty text. An empty table gives no rows. Other columns are left behind, whatever their names.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, scale, dims, id_, vector)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    starts = rows.orderBy(name, F.col("id").asc_nulls_first(), "x").limit(k).select("x").collect()
    if not starts:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, dims), np.int64))
    at = Centres(np.array([r.x for r in starts], np.float64).astype(np.int64))
    table = None
    for _ in range(rounds):
        run = (rows.mapInArrow(_first_pass(at), _STATE_DDL) if table is None
               else _held(table).mapInArrow(_next_pass(at), _STATE_DDL))
        before, table = table, pin(run)
        if before is not None:
            unpin(before)
        at = Centres(_means(table, at.c), at.c)
    if table is None:
        table = pin(rows.mapInArrow(_first_pass(at), _STATE_DDL))
    members = pin(_held(table).mapInArrow(_last_pass(at), "vec_id long, cluster int, distance long"))
    unpin(table)
    return Clusters(members, at.c)


def described(found: Clusters) -> DataFrame:
    """Members with the inertia of their cluster and of all, and the digest of their centroid.

    A sum of squares that a long can't hold comes out as NULL. What is joined has a row per centroid.
    """
    spark = found.members.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")
    own = {r.cluster: int(r.own) for r in found.members.groupBy("cluster").agg(total).collect()}
    inertia = _long(sum(own.values()))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    about = spark.createDataFrame(
        [(i, _long(n), inertia, digest[i]) for i, n in sorted(own.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.members.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", *about.columns[1:])


def _long(n: int) -> int | None:
    return n if n < 1 << 63 else None

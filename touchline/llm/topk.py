"""Exact top-k by integer inner product, by no-random-access aggregation over sorted lists.

Candidates lie in blocks, each with a list per component sorted by value. All queries of a block read
the lists from the end that their component's sign favours, to growing depths. A candidate's lower
bound adds, for lists in which it has not turned up, what is left at the least, its upper bound what
the reading position still allows. Reading stops for a query when no candidate outside its best k
can come up to them; scores of those left are then resolved. What a block yields meets in a last ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATES = 4096
QUERIES = 1024
"""Rows in a block of either kind, about."""
AT_ONCE = 128
EXACT = float(1 << 53)


def _usable(vector: Column) -> Column:
    """Not null, and every component there and finite; an empty vector is usable."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < high)), F.lit(False))


def scaled(vectors: DataFrame, id_: str, vector: str, scale: int) -> DataFrame:
    """``id``, the components times ``scale`` rounded down, and their number; usable vectors with an id only."""
    rows = vectors.where(F.col(id_).isNotNull() & _usable(F.col(vector)))
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return rows.select(F.col(id_).cast("long").alias("id"), whole.alias("x"), F.size(vector).alias("dims"))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


class Lists:
    """A block of candidates in their order by id, with each one's rank in every component's list."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        by_value = np.argsort(self.x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, by_value, axis=0)
        self.rank = np.empty_like(by_value)
        np.put_along_axis(self.rank, by_value, np.arange(len(x))[:, None], axis=0)

    def read(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds, a row per query, after ``depth`` entries of every list."""
        n = len(self.ids)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        from_top, from_bottom = self.rank >= n - depth, self.rank < depth
        # What a list may still give at most, and gives at least, to those that have not turned up in it.
        next_top, next_bottom = self.sorted[max(0, n - depth - 1)], self.sorted[min(n - 1, depth)]
        seen_top, seen_bottom = np.where(from_top, self.x, 0), np.where(from_bottom, self.x, 0)
        seen = up @ seen_top.T + down @ seen_bottom.T
        high = seen + (up * next_top) @ (~from_top).T + (down * next_bottom) @ (~from_bottom).T
        low = seen + (up * self.sorted[0]) @ (~from_top).T + (down * self.sorted[-1]) @ (~from_bottom).T
        return low, high

    def best(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[list, list, list]:
        """Query, candidate and score of each query's best k here, a query itself left out."""
        n = len(self.ids)
        found_q, found_c, found_s = [], [], []
        open_, depth = np.arange(len(q)), max(1, min(n, 4 * k))
        own = self.ids[None, :] == query_ids[:, None]
        while len(open_):
            low, high = self.read(q[open_], depth)
            mine = own[open_]
            low[mine], high[mine] = -np.inf, -np.inf
            if n > k:
                bar = np.partition(low, n - k, axis=1)[:, n - k]
            else:
                bar = np.full(len(open_), -np.inf)
            left = (high >= bar[:, None]) & ~mine
            # Stop where few enough are left to resolve, or the lists are read to their ends.
            stop = (left.sum(axis=1) <= 4 * k) | (depth >= n)
            for r in np.flatnonzero(stop):
                who = np.flatnonzero(left[r])
                score = self.x[who] @ q[open_[r]]
                who = who[np.lexsort((self.ids[who], -score))[:k]]
                found_q.append(np.full(len(who), query_ids[open_[r]]))
                found_c.append(self.ids[who])
                found_s.append(self.x[who] @ q[open_[r]])
            open_, depth = open_[~stop], min(n, 2 * depth)
        return found_q, found_c, found_s


def _fits(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether every sum of products is exact in a double."""
    if not x.size or not q.size:
        return True
    return float(np.abs(x).max()) * float(np.abs(q).max()) * x.shape[1] < EXACT


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, id_: str = "vec_id",
    vector: str = "embedding", candidates: int = CANDIDATES, block: int = QUERIES,
) -> DataFrame:
    """Each query's ``k`` highest scores among all other rows: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` picks the query rows. The score is the inner product of the components times ``scale``
    rounded down; ties go to the smaller id. Only vectors of equal length meet. Vectors that are null or
    hold a null or non-finite component take no part, nor do rows with a null id. A query does not meet
    rows of its own id; rows that repeat an id and its vector count once, other rows of one id are
    candidates of their own, and of queries of one id any one counts. Products that a double can't hold exactly are added up as whole numbers; scores beyond 64 bits fail.
    """
    rows = scaled(vectors, id_, vector, scale).dropDuplicates(["id", "x"])
    asked = scaled(vectors.where(queries), id_, vector, scale).dropDuplicates(["id"])
    # One row per length of vectors.
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n")).join(
        asked.groupBy(F.col("dims").alias("d")).agg(F.count("*").alias("m")), F.col("dims") == F.col("d")
    ).select("d", F.ceil(F.col("n") / candidates).alias("cs"), F.ceil(F.col("m") / block).alias("qs"))
    hashed = F.xxhash64("id", "x")
    # Every candidate block meets every query block: rows are repeated by the blocks of the other kind only.
    c = rows.join(sizes, F.col("dims") == F.col("d")).select(
        "dims", F.pmod(hashed, "cs").alias("c"), "id", "x", "qs"
    ).select("dims", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs") - 1)).alias("q"), "id", "x")
    q = asked.join(sizes, F.col("dims") == F.col("d")).select(
        "dims", F.pmod(hashed, "qs").alias("q"), "id", "x", "cs"
    ).select("dims", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cs") - 1)).alias("c"), "q", "id", "x")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            dims = left["dims"][0].as_py()
            ids, asked_ids = left["id"].to_numpy(), right["id"].to_numpy()
            x = _matrix(left["x"], dims) if dims else np.zeros((len(ids), 1))
            y = _matrix(right["x"], dims) if dims else np.zeros((len(asked_ids), 1))
            if not _fits(x, y):
                x, y = x.astype(object), y.astype(object)
                x, y = np.vectorize(int, otypes=[object])(x), np.vectorize(int, otypes=[object])(y)
            lists = Lists(ids, x) if x.dtype != object else None
            for a in range(0, len(y), AT_ONCE):
                part = slice(a, a + AT_ONCE)
                some = lists.best(asked_ids[part], y[part], k) if lists else _plain(ids, x, asked_ids[part], y[part], k)
                for whole, more in zip(out, some, strict=True):
                    whole.extend(more)
        joined = [np.concatenate(o) if o else np.zeros(0) for o in out]
        return pa.table({
            "query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)),
            "score": pa.array(joined[2].astype(np.int64)),
        })

    found = c.groupBy("dims", "c", "q").cogroup(q.groupBy("dims", "c", "q")).applyInArrow(
        meet, "query_id long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _plain(ids, x, query_ids, q, k):
    """The same for whole numbers of any size, added up in full."""
    out = ([], [], [])
    for query, y in zip(query_ids, q, strict=True):
        score = x @ y
        order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-score[i], ids[i]))[:k]
        for whole, more in zip(out, (np.full(len(order), query), ids[order], score[order]), strict=True):
            whole.append(more)
    return out

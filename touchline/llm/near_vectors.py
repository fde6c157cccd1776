"""Near-duplicate vectors by small-world graphs per shard, confirmed by cosine and joined into components.

Equal vectors of a label are one class from the start. The classes of a label are cut into shards of
bounded size, each with its own graph; every class queries every shard of its label. A query whose beam
is full of near ones gets a wider beam, and so do all queries of a pair of shards while an audit against
all products fails; past a 32nd of the shard the products themselves are taken.

The audit asks for the nearest ten, whatever their cosine, of queries and of the vectors with the fewest links to
them, so it measures the search also where links are rare. Vectors that a search for themselves does not find
are compared with every query by products.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.components import components
from touchline.llm.hnsw import Graph
from touchline.session import pin

SHARD = 4096
BEAM = 64
AUDIT = 64
"""Queries of a pair of shards that are held against all products, and as many vectors with few links to them."""
NEAREST = 11
"""Vectors that each of those has to find: itself, where it is among them, and the ten nearest."""
WIDEST = 32
"""A beam of more than one in this many vectors of a shard costs more than all products."""
MARGIN = 1e-4
"""What single precision may take from a similarity."""


def _usable(vector: Column) -> Column:
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < high))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column, dims: int) -> np.ndarray:
    """Vectors of length one in double precision, also where squares would leave the range."""
    x = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pack(graph: Graph) -> bytes:
    out = io.BytesIO()
    np.savez(out, entry=graph.entry, lost=graph.lost, **{f"layer{k}": layer for k, layer in enumerate(graph.layers)})
    return out.getvalue()


def _unpack(packed: bytes, x: np.ndarray) -> Graph:
    graph, held = Graph.__new__(Graph), np.load(io.BytesIO(packed))
    graph.x, graph.entry = np.ascontiguousarray(x, np.float32), int(held["entry"])
    graph.lost = held["lost"]
    graph.layers = [held[f"layer{k}"] for k in range(len(held.files) - 2)]
    return graph


def _exact(q: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """All links of queries, by products in blocks."""
    rows, found = [], []
    for a in range(0, len(q), 256):
        r, c = np.nonzero(q[a:a + 256] @ x.T >= least)
        rows.append(r + a)
        found.append(c)
    return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(found or [np.zeros(0, int)])


def _audit(asked: np.ndarray, x: np.ndarray, graph: Graph, least: float, beam: int) -> tuple[int, int, bool]:
    """Of the nearest of ``asked`` how many are sought and found, and whether a link is missed.

    Queries whose beam is full of near ones are left out, as they get a wider one.
    """
    ids, score = graph.search(asked, beam)
    rows = np.flatnonzero((score[:, -1] < least - MARGIN) | (beam >= len(x)))
    true, k = asked[rows] @ x.T, min(NEAREST, len(x))
    seen = np.zeros((len(rows), len(x) + 1), bool)  # the last column takes what is no vector
    seen[np.arange(len(rows))[:, None], ids[rows]] = True
    seen = seen[:, :-1]
    seen[:, graph.lost] = True
    # Equals of the last of the nearest will do in its place.
    nearest = true >= np.partition(true, -k, axis=1)[:, -k:].min(axis=1, keepdims=True) - 1e-6
    hits = np.minimum((seen & nearest).sum(axis=1), k).sum()
    return k * len(rows), int(hits), bool(((true >= least) & ~seen).any())


def links(
    q: np.ndarray, x: np.ndarray, graph: Graph, least: float, beam: int = BEAM
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Rows of ``q`` and of ``x`` whose cosine is ``least`` or more, found through the graph of ``x``.

    With them the audit's neighbours sought and found at the beam that was taken.
    """
    audited = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    weak = np.argsort(np.bincount(graph.layers[0][graph.layers[0] >= 0], minlength=len(x)), kind="stable")
    asked, beam = np.concatenate([q[audited], x[weak[:AUDIT]]]), min(beam, len(x))
    while True:
        sought, hits, missed = _audit(asked, x, graph, least, beam)
        if hits == sought and not missed:
            break
        beam *= 4
        if WIDEST * beam > len(x):
            rows, found = _exact(q, x, least)
            return rows, found, sought, sought
    rows, found = [], []
    open_, width = np.arange(len(q)), beam
    while len(open_) and (width == beam or WIDEST * width <= len(x)):
        ids, score = graph.search(q[open_], width)
        # A beam that holds only near ones may have left others out.
        full = (score[:, -1] >= least - MARGIN) & (width < len(x))
        r, c = np.nonzero((score >= least - MARGIN) & (ids >= 0) & ~full[:, None])
        rows.append(open_[r])
        found.append(ids[r, c])
        open_, width = open_[full], 4 * width
    r, c = _exact(q[open_], x, least)
    also, lost = _exact(q, x[graph.lost], least)
    rows, found = np.concatenate([*rows, open_[r], also]), np.concatenate([*found, c, graph.lost[lost]])
    pair = np.unique(rows * len(x) + found)
    rows, found = pair // len(x), pair % len(x)
    cosine = np.einsum("nd,nd->n", q[rows], x[found])
    return rows[cosine >= least], found[cosine >= least], sought, hits


def _forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links reach."""
    root = np.arange(n)
    while True:
        least = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        np.minimum.at(least, root, least)
        least = least[least]
        if (least == root).all():
            return root
        root = least


_LINKED = "cid long, links long, root long, sought long, hits long"


def _summed(
    cid: np.ndarray, times: np.ndarray, u: np.ndarray, v: np.ndarray, sought: int = 0, hits: int = 0
) -> pa.Table:
    """A row for each node with a link: the vectors it links with, and the first node of its tree.

    ``u`` and ``v`` hold each link once. So a shard leaves no more rows than it has classes, and one without a
    node for its audit.
    """
    count = np.bincount(u, times[v], len(cid)) + np.bincount(v, times[u], len(cid))
    root = _forest(len(cid), u, v)
    linked = np.flatnonzero(count)
    none = [None] * len(linked)
    return pa.table({
        "cid": pa.array([*cid[linked].tolist(), None], pa.int64()),
        "links": pa.array([*count[linked].astype(np.int64).tolist(), None], pa.int64()),
        "root": pa.array([*cid[root[linked]].tolist(), None], pa.int64()),
        "sought": pa.array([*none, sought], pa.int64()), "hits": pa.array([*none, hits], pa.int64()),
    })


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, id_: str = "vec_id", vector: str = "embedding",
    label: str = "label", shard: int = SHARD, with_recall: bool = False,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Rows link when their labels are equal and not null, their vectors are of one length and their cosine in
    double precision is ``least`` or more. Vectors that are null, empty, zero or hold a null or non-finite
    component link with nothing. ``n_links`` counts the other rows linked directly, copies included;
    ``component_id`` is the smallest id that links reach, a row's own included, where null ids count only
    if there are no others; ``kept`` says that it is the row's own. Rows that repeat an id are rows of
    their own. Other columns take no part. ``with_recall`` adds ``recall``, one value: the share of nearest vectors that the audits of
    all pairs of shards found, 1 for pairs that were searched by products, null where there was no pair.
    """
    rows = vectors.select(F.col(id_).alias("id"), F.col(vector).alias("x"), F.col(label).alias("label"))
    rows = rows.withColumn("cid", F.when(_usable(F.col("x")) & F.col("label").isNotNull(), F.xxhash64("label", "x")))
    classes = rows.where("cid IS NOT NULL").groupBy("cid", "label", "x").agg(
        F.min("id").alias("rep"), F.count("*").alias("times")
    ).withColumn("dims", F.size("x"))
    sizes = classes.groupBy("label", "dims").agg(F.ceil(F.count("*") / shard).alias("shards"))
    classes = pin(classes.join(sizes, ["label", "dims"]).withColumn("s", F.pmod(F.xxhash64("cid"), "shards")))
    group = ["label", "dims", "s"]

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        x = _unit(table["x"], table["dims"][0].as_py())
        return pa.table({
            "label": table["label"][:1].cast(pa.string()), "dims": table["dims"][:1], "s": table["s"][:1],
            "graph": pa.array([_pack(Graph(x))], pa.binary()), "shards": table["shards"][:1],
        })

    wanted = classes.select(F.col("label").cast("string").alias("label"), "dims", "s", "shards", "cid", "x", "times")
    graphs = pin(wanted.groupBy(*group).applyInArrow(
        build, "label string, dims int, s long, graph binary, shards long"
    ))
    # Each pair of a label's shards is one task: the first with its graph, the second as queries.
    other = F.explode(F.sequence("s", F.col("shards") - 1)).alias("t")
    index = wanted.select("label", "dims", "s", other, "cid", "x", "times", F.lit(None).cast("binary").alias("graph"))
    index = index.unionByName(graphs.select(
        "label", "dims", "s", other, F.lit(None).cast("long").alias("cid"),
        F.lit(None).cast(wanted.schema["x"].dataType).alias("x"), F.lit(None).cast("long").alias("times"), "graph",
    ))
    asked = wanted.select(
        "label", "dims", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s"))).alias("s"),
        F.col("s").alias("t"), "cid", "x", "times",
    ).toDF("label", "dims", "s", "t", "cid", "x", "times")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _summed(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, int), np.zeros(0, int))
        left, right = left.sort_by("cid"), right.sort_by("cid")  # the graph's row has no cid and comes last
        packed = left["graph"][left.num_rows - 1].as_py()
        left, dims = left.slice(0, left.num_rows - 1), left["dims"][0].as_py()
        x, same = _unit(left["x"], dims), left["s"][0].as_py() == right["t"][0].as_py()
        q = x if same else _unit(right["x"], dims)
        r, c, sought, hits = links(q, x, _unpack(packed, x), least)
        cid, times = left["cid"].to_numpy(), left["times"].to_numpy().astype(float)
        if same:
            pair = np.unique(np.minimum(r, c)[r != c] * len(x) + np.maximum(r, c)[r != c])
            return _summed(cid, times, pair // len(x), pair % len(x), sought, hits)
        return _summed(
            np.concatenate([cid, right["cid"].to_numpy()]),
            np.concatenate([times, right["times"].to_numpy().astype(float)]), c, r + len(x),
            sought, hits,
        )

    pair = ["label", "dims", "s", "t"]
    found = pin(index.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInArrow(meet, _LINKED))
    recall = [found.agg(F.sum("hits") / F.sum("sought")).scalar().alias("recall")] if with_recall else []
    found = found.where("cid IS NOT NULL")
    roots = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    placed = classes.select("cid", "rep", "times").join(counts, "cid", "left").join(
        roots.withColumnRenamed("node", "cid"), "cid", "left"
    )
    smallest = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least"))
    placed = placed.join(smallest, "root", "left").where("times > 1 OR root IS NOT NULL").select(
        "cid", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("least", "rep").alias("component_id"),
    )
    out = rows.select("id", "cid").join(placed, "cid", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
        *recall,
    )

"""Near-duplicate texts by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Each tree sorts the distinct sets by its own order of the signature. Sets that share the first few
values of an order (``forest`` says how many) are a region, where they lie in order of their longest common prefixes; a
crowded region is cut deeper, as far as it needs. In a region every pair is weighed by its signatures, and
each set proposes the best of those before it. What the texts confirm is joined into components; then all
pairs that a region holds across components are weighed and confirmed too, in blocks where it is crowded,
so neither the depth of a region nor its proposals lose a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.batches import add_columns
from touchline.llm.components import components
from touchline.llm.words import NOT_BLANK, mix, words
from touchline.session import pin

SHINGLE = 5
HASHES = 128
LEAST_TREES, MOST_TREES = 16, 18
RECALL = 0.9999
"""Probability, at least, that a pair of just the linking similarity shares a region of some tree."""
DEEPEST = 40
CROWD = 2048
"""Sets in a region, or in a block of a crowded one, that are weighed at once."""
OVERLOOKED = 2e-5
"""Probability, at most, that the estimate of a pair of just the linking similarity is below what is weighed."""
BROADCAST_ROWS = 500_000



@cache
def forest(percent: int) -> tuple[int, int]:
    """Trees, and values that the sets of a region share, for links at ``percent``: 16 and 5 at 85, 18 and 4 at 80.

    The deepest regions for which ``MOST_TREES`` keep ``RECALL``; at a depth of 1 as many trees as that takes.
    """
    for depth in range(HASHES // MOST_TREES, 0, -1):
        for trees in range(LEAST_TREES, (MOST_TREES if depth > 1 else HASHES) + 1):
            if 1 - (1 - (percent / 100) ** depth) ** trees >= RECALL:
                return trees, depth
    raise ValueError(f"{HASHES} hashes are too few for links at {percent} percent")


@cache
def slack(percent: int) -> float:
    """How far an estimate may lie below the similarity, for links at ``percent``: 0.14 at 85, 0.16 at 80."""
    p, steps = percent / 100, 1
    while sum(comb(HASHES, k) * p**k * (1 - p)**(HASHES - k) for k in range(ceil((p - steps / 100) * HASHES - 1e-9))) > OVERLOOKED:
        steps += 1
    return steps / 100


TREES, DEPTH = forest(85)
SLACK = slack(85)
_rng = np.random.default_rng(20)
_TIMES = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes; words are lower-cased in A to Z only."""
    found = words([(t or "").encode("utf-8", "replace").lower() for t in texts], NOT_BLANK)
    hashes, bounds = found.hashes(), found.bounds(len(texts))
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
        for j, place in enumerate(_PLACES):
            runs += hashes[j:j + len(runs)] * place
        runs = mix(runs)
        sets = []
        for a, b in zip(bounds, bounds[1:]):
            if b - a >= SHINGLE:
                sets.append(np.unique(runs[a:b - SHINGLE + 1]))
            elif b > a:
                whole = (hashes[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                sets.append(mix(np.array([whole], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _identity(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set."""
    with np.errstate(over="ignore"):
        return mix(np.array([mix(s ^ _TIMES[0]).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets], np.uint64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``HASHES`` bytes per set, of the smallest value of each hash function; zeros for an empty set."""
    sizes = np.array([len(s) for s in sets])
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sets), HASHES), np.uint8)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        with np.errstate(over="ignore"):
            for k, times in enumerate(_TIMES):
                out[full, k] = mix(np.minimum.reduceat(values * times, starts)) >> np.uint64(56)
    return out


def _described(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``n`` shingles, ``cid`` (the same for equal sets) and ``sig``."""
    def begin():
        def compute(texts):
            sets = shingles(texts)
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(_identity(sets).view(np.int64), pa.int64()),
                pa.array([row.tobytes() for row in signatures(sets)], pa.binary()),
            ]
        return compute

    return add_columns(docs, text, {"n": "long", "cid": "long", "sig": "binary"}, begin).drop(text)


def _prefix(tree: Column, depth: int, trees: int) -> Column:
    """The region of a set in a tree: a tree's order is the signature turned by ``HASHES / trees`` a tree."""
    turned = F.substring(F.concat("sig", "sig"), tree * (HASHES // trees) + 1, F.lit(depth))
    return F.xxhash64(tree, F.lit(depth), turned)


def regions(classes: DataFrame, percent: int, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``region``, ``tree`` and ``cid`` of every set that shares one: those of bounded size, and the crowded ones.

    Crowded regions, with more than ``crowd`` sets at the forest's depth, appear whole in the second; in the first
    they are cut deeper until each part is small, or, where whole signatures are alike, by hash.
    """
    trees, depth = forest(percent)
    every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    rows = classes.select("cid", "sig", every)
    keyed = rows.select(_prefix(F.col("tree"), depth, trees).alias("region"), "cid", "tree")
    counts = pin(keyed.groupBy("region").agg(F.count("*").alias("size")).where("size > 1"))
    small = keyed.join(counts.where(F.col("size") <= crowd).select("region"), "region").select("region", "tree", "cid")
    crowded = keyed.join(counts.where(F.col("size") > crowd), "region")
    rest = crowded.select("cid", "tree")
    whole = crowded.select("region", "tree", "cid")
    while counts.where(F.col("size") > crowd).limit(1).count():
        depth = min(2 * depth, DEEPEST)
        deeper = pin(rest.join(classes.select("cid", "sig"), "cid").select(
            _prefix(F.col("tree"), depth, trees).alias("region"), "cid", "tree"
        ))
        counts = pin(deeper.groupBy("region").agg(F.count("*").alias("size")).where("size > 1"))
        part = F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / crowd)) if depth == DEEPEST else F.lit(0)
        fits = deeper.join(counts if depth == DEEPEST else counts.where(F.col("size") <= crowd), "region")
        small = small.unionByName(fits.select(F.xxhash64("region", part).alias("region"), "tree", "cid"))
        if depth == DEEPEST:
            break
        rest = deeper.join(counts.where(F.col("size") > crowd), "region").select("cid", "tree")
    return small, whole


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signature values, a row per row of ``a``."""
    out = np.empty((len(a), len(b)), np.float32)
    step = max(1, (1 << 22) // max(1, len(b) * HASHES))
    for i in range(0, len(a), step):
        out[i:i + step] = (a[i:i + step, None, :] == b[None, :, :]).mean(axis=2, dtype=np.float32)
    return out


def _may_link(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """No set of size a has ``percent`` of similarity with one of size b unless this holds."""
    return 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)


def _proposals(cid, n, sig, percent: int):
    """Of each set of a region the most alike before it, if it may link."""
    order = np.argsort(cid)
    cid, n, sig = cid[order], n[order], sig[order]
    likely = _alike(sig, sig)
    ok = (likely >= percent / 100 - slack(percent)) & _may_link(n[:, None], n[None, :], percent)
    score = np.where(ok & np.tri(len(cid), k=-1, dtype=bool), likely, -1)
    a = score.argmax(axis=1)
    b = np.flatnonzero(score[np.arange(len(cid)), a] >= 0)
    return cid[a[b]], cid[b], likely[b, a[b]]


def _linked(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


class _Side:
    """Sets of a region or of a block of one; their shingles are worked out when a pair needs them."""

    def __init__(self, table: pa.Table):
        self.cid, self.n, self.comp = (table[c].to_numpy() for c in ("cid", "n", "comp"))
        self.tree = table["tree"][0].as_py()
        self.sig, self.text, self.sets = _matrix(table["sig"]), table["text"], {}

    def set_of(self, i: int) -> np.ndarray:
        if i not in self.sets:
            self.sets[i] = shingles([self.text[i].as_py()])[0]
        return self.sets[i]


def _links_across(left: _Side, right: _Side, percent: int):
    """Confirmed links between components of two sides, no more than join what they have apart.

    A pair that shares regions of several trees is looked at in the first of them.
    """
    likely = _alike(left.sig, right.sig)
    ok = (likely >= percent / 100 - slack(percent)) & _may_link(left.n[:, None], right.n[None, :], percent)
    i, j = np.nonzero(ok & (left.comp[:, None] != right.comp[None, :]) & (left.cid[:, None] < right.cid[None, :])
                      if left is right else ok & (left.comp[:, None] != right.comp[None, :]))
    mine = np.zeros(len(i), bool)
    trees, depth = forest(percent)
    turn = HASHES // trees
    for a in range(0, len(i), 1 << 14):
        part = slice(a, a + (1 << 14))
        same = (left.sig[i[part], :trees * turn] == right.sig[j[part], :trees * turn])
        same = same.reshape(-1, trees, turn)[:, :, :depth].all(axis=2)
        mine[part] = same.argmax(axis=1) == left.tree
    i, j = i[mine], j[mine]
    order = np.argsort(-likely[i, j], kind="stable")
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    found = []
    for p, q in zip(i[order].tolist(), j[order].tolist()):
        one, other = find(int(left.comp[p])), find(int(right.comp[q]))
        if one != other:
            x, y = left.set_of(p), right.set_of(q)
            at = np.searchsorted(y, x)
            common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            if _linked(common, len(x), len(y), percent):
                found.append((left.cid[p], right.cid[q], likely[p, q]))
                root[max(one, other)] = min(one, other)
    return tuple(np.array(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


_FOUND = "a long, b long, likely float"


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


_MEMBER = ["region", "tree", "cid", "n", "comp", "sig", "text"]


def _weigh(members: DataFrame, percent: int) -> DataFrame:
    """Pairs from every region of ``members``: with the columns ``_MEMBER`` links across components, with
    ``region``, ``cid``, ``n`` and ``sig`` proposals.

    Regions are of bounded size; those of a partition follow one another, so a task holds one at a time.
    """
    confirm = "text" in members.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if table.num_rows == 0:
                continue
            region = table["region"].to_numpy()
            before = np.flatnonzero(region != region[-1])
            last = int(before[-1]) + 1 if len(before) else 0
            if last == 0 and held and held[-1]["region"][0].as_py() == region[-1]:
                held.append(table)
                continue
            done = pa.concat_tables([*held, table.slice(0, last)])
            if done.num_rows:
                yield by_region(done)
            held = [table.slice(last)]
        if held:
            yield by_region(pa.concat_tables(held))

    def by_region(table: pa.Table) -> pa.RecordBatch:
        region = table["region"].to_numpy()
        cuts = np.flatnonzero(np.diff(region)) + 1
        found = []
        if confirm:
            for s, e in zip([0, *cuts], [*cuts, len(region)]):
                side = _Side(table.slice(s, e - s))
                found.append(_links_across(side, side, percent))
        else:
            cid, n, sig = table["cid"].to_numpy(), table["n"].to_numpy(), _matrix(table["sig"])
            found = [
                _proposals(cid[s:e], n[s:e], sig[s:e], percent)
                for s, e in zip([0, *cuts], [*cuts, len(region)]) if e - s > 1
            ]
        return _found(found)

    dealt = members.repartition("region").sortWithinPartitions("region")
    return dealt.select(*(_MEMBER if confirm else ["region", "cid", "n", "sig"])).mapInArrow(run, _FOUND)


def _found(parts: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*parts) if parts else ((), (), ()))]
    kinds = (np.int64, np.int64, np.float32)
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(k)) for c, k in zip(columns, kinds)], names=["a", "b", "likely"]
    )


def _weigh_crowded(members: DataFrame, percent: int, crowd: int = CROWD) -> DataFrame:
    """Links across components from regions of any size.

    Sets outside a region's largest component meet all its sets, in blocks of both.
    """
    per = members.groupBy("region", "comp").agg(F.count("*").alias("c"))
    main = per.groupBy("region").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("main"), F.sum("c").alias("size"), F.max("c").alias("most")
    ).where("size > most").select(
        "region", "main", F.ceil(F.col("size") / crowd).alias("blocks"),
        F.ceil((F.col("size") - F.col("most")) / crowd).alias("others"),
    )
    rows = members.select(*_MEMBER).join(main, "region")
    one = F.lit(0).cast("long")
    left = rows.withColumn("i", F.pmod(F.xxhash64("cid"), "blocks")).withColumn(
        "j", F.explode(F.sequence(one, F.col("others") - 1)))
    right = rows.where("comp <> main").withColumn("j", F.pmod(F.xxhash64("cid"), "others")).withColumn(
        "i", F.explode(F.sequence(one, F.col("blocks") - 1)))
    keep = [*_MEMBER, "i", "j"]

    def meet(l: pa.Table, r: pa.Table) -> pa.Table:
        found = [_links_across(_Side(l), _Side(r), percent)] if l.num_rows and r.num_rows else []
        return pa.Table.from_batches([_found(found)])

    return left.select(*keep).toDF(*keep).groupBy("region", "i", "j").cogroup(
        right.select(*keep).toDF(*keep).groupBy("region", "i", "j")
    ).applyInArrow(meet, _FOUND)


def _texts(need: DataFrame, classes: DataFrame, docs: DataFrame, id_: str, text: str) -> DataFrame:
    """``cid`` and ``text`` of the classes of ``need``, whose ``cid`` are distinct."""
    need = pin(need.join(classes.select("cid", "rep"), "cid"))
    # Broadcast up to a size that is checked; beyond it the join moves the texts.
    ids = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    given = docs.select(F.col(id_).alias("id"), F.col(text).alias("text"))
    found = given.join(ids, F.col("id").eqNullSafe(F.col("rep"))).select("cid", "text")

    def own():
        return lambda texts: [pa.array(_identity(shingles(texts)).view(np.int64), pa.int64())]

    # Rows that repeat an id may have other texts, and rows of one class that repeat it are the same.
    texts = pin(add_columns(found, "text", {"own": "long"}, own).where("own = cid").select("cid", "text"))
    return texts.groupBy("cid").agg(F.min("text").alias("text")) if need.count() < texts.count() else texts


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_: str, text: str, percent: int) -> DataFrame:
    """``a``, ``b`` and ``linked`` of ``pairs``, on the full sets of their texts."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    texts = _texts(need, classes, docs, id_, text)
    with_a = pairs.select("a", "b").join(texts.select(F.col("cid").alias("a"), F.col("text").alias("x")), "a")
    with_b = with_a.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("y")), "b")

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            for at in range(0, len(a), 64):
                one, other = shingles(x[at:at + 64]), shingles(y[at:at + 64])
                common = [len(np.intersect1d(s, t, assume_unique=True)) for s, t in zip(one, other)]
                linked = [_linked(c, len(s), len(t), percent) for c, s, t in zip(common, one, other)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[at:at + 64], pa.int64()), pa.array(b[at:at + 64], pa.int64()), pa.array(linked)],
                    names=["a", "b", "linked"],
                )

    return with_b.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _judged(docs: DataFrame, percent: int, id_: str, text: str, crowd: int) -> DataFrame:
    """``id``, ``n``, ``cid`` (null for no shingles), ``component_id`` and ``lead``, the first class, of every row."""
    found = pin(_described(docs.select(F.col(id_).alias("id"), F.col(text).alias("text")), "text"))
    # Equal sets have equal signatures, so the group holds one number only.
    sets = found.where("n > 0").groupBy("cid", "n", "sig").agg(F.min("id").alias("rep"), F.count("*").alias("times"))
    classes = pin(sets)
    few, crowded = regions(classes, percent, crowd)
    few, crowded = pin(few), pin(crowded)
    facts = classes.select("cid", "n", "sig")
    best = _weigh(few.join(facts, "cid"), percent)
    best = best.groupBy("b").agg(F.max_by("a", F.struct("likely", "a")).alias("a")).select("a", "b")
    first = pin(confirmed(pin(best), classes, docs, id_, text, percent))
    links = first.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = pin(components(links))

    def apart(rows: DataFrame) -> DataFrame:
        placed = rows.join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        placed = placed.withColumn("comp", F.coalesce("root", "cid")).drop("root")
        # Regions that one component fills have nothing left to weigh.
        mixed = placed.groupBy("region").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        return pin(placed.join(mixed.select("region"), "region", "left_semi"))

    few, crowded = apart(few), apart(crowded)
    need = few.select("cid").unionByName(crowded.select("cid")).distinct()
    facts = facts.join(_texts(need, classes, docs, id_, text), "cid")
    late = _weigh(few.join(facts, "cid"), percent)
    late = pin(late.unionByName(_weigh_crowded(crowded.join(facts, "cid"), percent, crowd)))
    if late.limit(1).count():
        roots = components(links.unionByName(late.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    placed = classes.select("cid", "rep", "times").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    grouped = placed.where("root IS NOT NULL").groupBy("root").agg(
        F.min("rep").alias("least"), F.min(F.struct(F.col("rep").isNull(), "rep", "cid"))["cid"].alias("lead")
    )
    placed = placed.join(grouped, "root", "left").where("times > 1 OR root IS NOT NULL")
    placed = placed.select("cid", F.coalesce("least", "rep").alias("component_id"), F.coalesce("lead", "cid").alias("lead"))
    out = found.select("id", "n", F.when(F.col("n") > 0, F.col("cid")).alias("cid")).join(placed, "cid", "left")
    return out.select(
        "id", "n", "cid", F.coalesce("component_id", "id").alias("component_id"), F.coalesce("lead", "cid").alias("lead")
    )


def near_duplicates(
    docs: DataFrame, percent: int = 85, id_: str = "doc_id", text: str = "text", crowd: int = CROWD
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row of ``docs``.

    Texts link when ``100 * common >= percent * all`` of their distinct shingles of five words; a text of
    fewer words is one shingle, and a null, empty or blank one has none and links with nothing. Texts with
    equal sets are one class from the start. ``component_id`` is the smallest id that links reach, a row's
    own included; null ids are reached but never the smallest, unless there are no others. ``kept`` says that
    it is the row's own, so rows that repeat a kept id are all kept. Other columns of ``docs`` take no part.
    """
    return _judged(docs, percent, id_, text, crowd).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def firsts(docs: DataFrame, percent: int, id_: str, text: str, crowd: int = CROWD) -> DataFrame:
    """``doc_id``, ``cid`` and ``first`` of every row of ``docs``; ``cid`` as ``with_identity`` has it.

    ``first`` is true for rows of one ``doc_id`` and one ``cid`` per component, also where ids repeat, and for
    texts without words.
    """
    first = F.col("cid").isNull() | (F.col("cid") == F.col("lead")) & F.col("id").eqNullSafe(F.col("component_id"))
    return _judged(docs, percent, id_, text, crowd).select(F.col("id").alias("doc_id"), "cid", first.alias("first"))


def with_identity(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with a column that is the same for equal sets of shingles, and null for none."""
    def begin():
        def compute(texts):
            sets = shingles(texts)
            return [pa.array(_identity(sets).view(np.int64), pa.int64(), mask=np.array([len(s) == 0 for s in sets]))]
        return compute

    return add_columns(docs, text, {name: "long"}, begin)

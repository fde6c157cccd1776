"""Near-duplicates and top-k against brute force, with copies, ties, odd vectors and cut groups."""

import math
import re
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, difference
from touchline.llm import near_texts, near_vectors, topk
from touchline.llm.components import components
from touchline.llm.hnsw import Graph

FOLDER = "/root/testdata/sf0.001"


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else (
        frozenset([tuple(words)]) if words else frozenset())


def _brute(texts, percent=85):
    """Root and number of shingles by id, all pairs tried."""
    sets = {i: _shingles(t) for i, t in texts}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return _roots(ids, links), {i: len(s) for i, s in sets.items()}


def _check_texts(found, texts):
    roots, sizes = _brute(texts)
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], roots[r.doc_id], roots[r.doc_id] == r.doc_id)


@pytest.fixture(scope="module")
def edited():
    """Groups of edited copies around the limit, some large, on a shared passage."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    texts, n = [], 0
    for size in [60, 25, 8, 3, 2, 2, 1, 1, 1, 1]:
        base = [rng.choice(words) for _ in range(rng.randint(60, 150))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((n, (passage + " " if n % 3 == 0 else "") + " ".join(copy)))
            n += 1
    return texts + [(n + i, t) for i, t in enumerate(["a b", "A\tb ", "a b c", "ä b", "Ä b"])]


@pytest.mark.parametrize("crowd", [2048, 6])
def test_texts_equal_brute_force(spark, edited, crowd):
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    _check_texts(near_texts.near_duplicates(docs, crowd=crowd), edited)


def test_given_texts_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    _check_texts(contract.queries()["op9_forest_near_texts"](spark, FOLDER), texts)


def test_texts_of_odd_rows(spark):
    long = "one two three four five six seven " * 4000
    rows = [(5, None), (6, ""), (7, " \n"), (8, long), (3, long), (3, long), (None, long), (None, "all alone here"), (9, "all alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("CID", F.lit("x")).withColumn("n", F.lit(1))
    found = sorted(near_texts.near_duplicates(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_shingles))
    assert [(r.doc_id, r.component_id, r.kept) for r in found] == [
        (3, 3, True), (3, 3, True), (5, 5, True), (6, 6, True), (7, 7, True), (8, 3, False), (9, 9, True),
        (None, 9, False), (None, 3, False),
    ]
    assert near_texts.near_duplicates(docs.where("false")).count() == 0
    unnamed = spark.createDataFrame([(None, "just these words"), (None, "other words")], "doc_id long, text string")
    assert [(r.component_id, r.kept) for r in near_texts.near_duplicates(unnamed).collect()] == [(None, True)] * 2


def test_regions_keep_recall():
    share = 1 - (1 - 0.85 ** near_texts.DEPTH) ** near_texts.TREES
    assert share > 0.9999
    assert near_texts.SLACK > 3 * math.sqrt(0.85 * 0.15 / near_texts.HASHES)


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 90])
def test_forests_keep_recall_at_every_percentage(percent):
    trees, depth = near_texts.forest(percent)
    assert trees * depth <= near_texts.HASHES
    assert 1 - (1 - (percent / 100) ** depth) ** trees > 0.9999


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 90])
def test_estimates_overlook_fewer_pairs_than_regions(percent):
    weighed = math.ceil((percent / 100 - near_texts.slack(percent)) * near_texts.HASHES - 1e-9)
    p = percent / 100
    below = sum(math.comb(128, k) * p**k * (1 - p)**(128 - k) for k in range(weighed))
    assert below <= 2e-5


@pytest.mark.parametrize("crowd", [2048, 6])
def test_texts_equal_brute_force_at_80(spark, edited, crowd):
    docs = spark.createDataFrame(edited, "doc_id long, text string")
    roots, _ = _brute(edited, 80)
    assert roots != _brute(edited)[0]
    found = near_texts.near_duplicates(docs, 80, crowd=crowd).collect()
    assert {r.doc_id: r.component_id for r in found} == roots


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(i, 1000 + i % 7) for i in range(300)],
    [(3, 3), (1, 2), (2, 1), (1, 2)], [],
])
def test_components(spark, links):
    links = [(b, a) for a, b in links]
    edges = spark.createDataFrame(links, "u long, v long")
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in components(edges).collect()} == _roots(nodes, [x for x in links if x[0] != x[1]])


def _vectors(rng, groups, dims=16, noise=0.02):
    rows, n = [], 0
    for label, size in groups:
        center = rng.normal(size=dims)
        for _ in range(size):
            rows.append((n, (center + noise * rng.normal(size=dims)).astype(np.float32).tolist(), label))
            n += 1
    return rows


def _check_vectors(found, rows, least=0.98):
    ok = [(i, np.array(x, float) / np.linalg.norm(x), label) for i, x, label in rows]
    links = [(a, b) for a, x, p in ok for b, y, q in ok if a < b and p == q and len(x) == len(y) and x @ y >= least]
    roots = _roots([i for i, _, _ in ok], links)
    count = {i: 0 for i in roots}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.collect()} == {
        i: (count[i], roots[i], roots[i] == i) for i in roots
    }


@pytest.mark.parametrize("shard", [4096, 40])
def test_vectors_equal_brute_force(spark, shard):
    rng = np.random.default_rng(4)
    rows = _vectors(rng, [(1, 120), (1, 30), (2, 20), (2, 1), (1, 1)] + [(1, 2)] * 40, noise=0.06)
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)] + [(2000, rows[0][1], 2), (2001, [2 * x for x in rows[0][1]], 1)]
    found = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), shard=shard)
    _check_vectors(found, rows)


def _apart(rng, n, pairs, dims=64):
    """Loose clusters, and pairs apart from them and from one another, in random order."""
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    loose = unit(unit(rng.normal(size=(8, dims)))[rng.integers(0, 8, n - 2 * pairs)] + 0.08 * rng.normal(size=(n - 2 * pairs, dims)))
    base = unit(rng.normal(size=(pairs, dims)))
    x = np.concatenate([loose, base, unit(base + 0.012 * rng.normal(size=base.shape))])
    return x[rng.permutation(n)]


@pytest.mark.parametrize("shard", [4096, 600])
def test_rare_links_apart_from_clusters_equal_brute_force(spark, shard):
    rows = [(i, x.astype(np.float32).tolist(), 1) for i, x in enumerate(_apart(np.random.default_rng(8), 2400, 60))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = near_vectors.near_duplicates(vectors, shard=shard, with_recall=True).cache()
    _check_vectors(found, rows)
    assert found.select("recall").distinct().collect()[0][0] == 1


def test_audit_sees_what_a_broken_graph_hides():
    """Without links to some vectors the audit fails, though no link of its queries is missed, and products follow."""
    x = _apart(np.random.default_rng(9), 4096, 40)
    graph = near_vectors.Graph(x)
    gone = np.arange(0, len(x), 3)
    for layer in graph.layers:
        layer[np.isin(layer, gone)] = -1
    sought, hits, _ = near_vectors._audit(x[:64], x, graph, 0.98, 64)
    assert hits < sought
    rows, found, _, _ = near_vectors.links(x, x, graph, 0.98)
    true = near_vectors._exact(x, x, 0.98)
    assert set(zip(rows, found)) == set(zip(*true))


def test_vectors_of_odd_rows(spark):
    x, nan = [1.0, 2.0], float("nan")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, x, None), (8, x, None), (9, x, 1), (9, x, 1), (None, x, 1), (10, [1.0, 2.0, 0.0], 1), (11, [1e30, 2e30], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cid", F.lit(1)).withColumn("S", F.lit(1))
    found = near_vectors.near_duplicates(vectors).collect()
    alone = {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 8, 10)}
    assert {tuple(r) for r in found} == alone | {(9, 3, 9, True), (None, 3, 9, False), (11, 3, 9, False)}
    assert len(found) == len(rows)
    assert near_vectors.near_duplicates(vectors.where("false")).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, exact = Graph(x), np.argsort(-(x[:300] @ x.T), axis=1)[:, :10]
    found, _ = graph.search(x[:300], 64)
    assert np.mean([len(set(a) & set(b[:10])) / 10 for a, b in zip(exact.tolist(), found.tolist())]) > 0.9
    assert len(Graph(x[:1]).search(x[:2], 5)[0]) == 2


@pytest.mark.parametrize("name", ["op8_no_random_access"])
def test_top_k_equals_sql(spark, name):
    assert difference(contract.queries()[name](spark, FOLDER), connect(FOLDER), contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("blocks", [(4096, 1024), (37, 3)])
def test_top_k_over_blocks_with_ties_and_odd_rows(spark, blocks):
    rng = np.random.default_rng(6)
    nan, inf = float("nan"), float("inf")
    rows = [(i, (rng.integers(-3, 4, 6) / 1024).tolist()) for i in range(400)]
    rows += [(500, None), (501, [nan] * 6), (502, [None] * 6), (600, [inf] * 6), (None, [0.1] * 6), (700, [0.1]), (701, [0.2]), (800, []), (7, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0)).withColumn("dims", F.lit(0))
    found = topk.top_k(vectors, F.col("vec_id") % 100 == 0, candidates=blocks[0], block=blocks[1])
    whole = {(i, tuple(math.floor(1024 * c) for c in x)) for i, x in rows
             if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)}
    expected = set()
    for q, x in whole:
        if q % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in whole if c != q and len(x) == len(y))[:10]
            expected |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(scores)}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert topk.top_k(vectors.where("false"), F.lit(True)).count() == 0


def test_top_k_of_large_components(spark):
    rows = [(0, [3e5, 1.0]), (1, [2e5, 7.0]), (2, [-4e5, 2.0]), (3, [3e5, 1.1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") == 0, scale=1024).collect()]
    whole = {i: [math.floor(1024 * c) for c in x] for i, x in rows}
    scores = sorted((-sum(a * b for a, b in zip(whole[0], whole[i])), i) for i in (1, 2, 3))
    assert got == [(0, k + 1, i, -s) for k, (s, i) in enumerate(scores)]


def test_reading_stops_before_the_lists_end():
    rng = np.random.default_rng(7)
    x = np.floor(1024 * np.abs(rng.normal(size=(2000, 3))) ** 3)
    lists, depths = topk.Lists(np.arange(2000), x), []
    read = lists.read
    lists.read = lambda q, depth: depths.append(depth) or read(q, depth)
    _, found, _ = lists.best(np.array([-1]), x[:1], 10)
    assert depths[-1] < 2000
    assert sorted(found[0]) == sorted(np.lexsort((np.arange(2000), -(x @ x[0])))[:10])

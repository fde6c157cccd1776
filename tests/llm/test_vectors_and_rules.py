"""Clusters, rule votes and whitening against brute force on the given tables and on odd rows."""

import hashlib
import math
import re

import numpy as np
import pytest

import __spark_entry__ as contract
from touchline.llm import rules, shallot, whitening

FOLDER = "/root/testdata/sf0.001"


def _vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding) for r in rows]


def _fit_for_use(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def _lloyd(rows, k=40, rounds=5, scale=256):
    """Every distance to every centroid, in Python's own whole numbers."""
    start = sorted(rows, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:k]
    centres = [[math.floor(scale * c) for c in v] for _, v in start]
    x = [[math.floor(scale * c) for c in v] for _, v in rows]
    for at in range(rounds + 1):
        nearest = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for v in x]
        if at < rounds:
            for j in range(len(centres)):
                own = [v for v, (_, i) in zip(x, nearest) if i == j]
                if own:
                    centres[j] = [sum(column) // len(own) for column in zip(*own)]
    return nearest, centres


def test_clusters_of_the_given_vectors(spark):
    rows = _vectors(spark)
    nearest, centres = _lloyd([r for r in rows if _fit_for_use(r[1]) and len(r[1]) == 64])
    found = {r.vec_id: r for r in contract.queries()["op11_shallot_clusters"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    total = sum(d for d, _ in nearest)
    for (i, _), (d, j) in zip(rows, nearest):
        r = found[i]
        assert (r.cluster, r.distance, r.inertia) == (j, d, total)
        assert r.cluster_inertia == sum(e for e, m in nearest if m == j)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    points = [(i, [float(i % 7), float(i % 3)]) for i in range(200)]
    odd = [(500, None), (501, []), (502, [1.0]), (503, [nan, 0.0]), (504, [inf, 0.0]), (505, [None, 0.0])]
    ties = [(600, [0.5, 0.5])] * 3
    kind = "vec_id long, embedding array<double>, cluster string, Distance int"
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in points + odd + ties], kind)
    got = shallot.cluster(frame, k=9, rounds=4, dims=2)
    nearest, centres = _lloyd(points + ties, k=9, rounds=4)
    assert got.centroids.tolist() == centres
    rows = sorted((r.vec_id, r.cluster, r.distance) for r in got.members.collect())
    assert rows == sorted((i, j, d) for (i, _), (d, j) in zip(points + ties, nearest))
    assert shallot.described(got).count() == len(rows)
    for few in (frame.limit(0), frame.where("vec_id >= 500 and vec_id < 600")):
        assert shallot.described(shallot.cluster(few, k=9, dims=2)).collect() == []
    assert [tuple(r) for r in shallot.cluster(frame.where("vec_id = 3"), k=9, dims=2).members.collect()] == [(3, 0, 0)]


def test_shallot_search_leaves_out_most_centroids():
    rng = np.random.default_rng(1)
    middle = rng.integers(-3000, 3000, (30, 8))
    x = (middle[rng.integers(0, 30, 3000)] + rng.integers(-50, 50, (3000, 8))).astype(np.int64)
    at = shallot.Centres(middle.astype(np.int64))
    state = shallot.start(x, at)
    moved = shallot.Centres(at.c + rng.integers(-5, 5, at.c.shape), at.c)
    new, searched = shallot.follow(x, state, moved)
    all_ = np.stack([shallot.squared(x, c) for c in moved.c], 1)
    assert (new.first == all_.argmin(1)).all()
    assert searched < 300


def _counts(text):
    """The contract's counts, word by word and window by window."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(inside)


ODD_TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h", "a " * 30, "a b c d e f g h i a b c d e f g h j", "x\ny\nx\n\n \nx",
    " nbsp em é漢字 \x0b\x0c\x1cfs 𝔘", "#*$%&|<>" * 3, "ab " * 5000, "w\r\nw\r\nw", " ".join(map(str, range(20000))),
]


def test_counts_of_odd_texts(spark):
    frame = spark.createDataFrame(
        [(i, t, 7, "k") for i, t in enumerate(ODD_TEXTS)] + [(3, "one", 7, "k")],
        "doc_id long, text string, N_Words int, kept string")
    got = rules.judge(frame)
    assert sorted(c.lower() for c in got.columns) == sorted(
        ["doc_id", "text", *rules.COUNTS, *rules.SHARES, "votes", "base_failed", "quality", "kept"])
    rows = got.collect()
    assert len(rows) == len(ODD_TEXTS) + 1
    for r in rows:
        text = ODD_TEXTS[r.doc_id]
        want = (5000, 10000, 0, 0, 5000) if text == "ab " * 5000 else (
            (20000, len(text) - 19999, 0, 0, 0) if len(text or "") > 90000 else _counts(text))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and not (failed and r.kept) and 0 <= r.quality <= 1
    assert rules.judge(frame.limit(0)).collect() == []


@pytest.fixture(scope="module")
def verdicts(spark):
    return contract.queries()["op12_rule_votes"](spark, FOLDER).collect()


def test_counts_of_the_given_documents(spark, verdicts):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(verdicts) == len(texts)
    for r in verdicts:
        if len(texts[r.doc_id] or "") < 20000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _counts(texts[r.doc_id])


def test_votes_tell_the_labelled_documents_apart(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = contract.queries()["op12_rule_votes"](spark, folder).drop("quality").join(labels, "doc_id").where(
        "not base_failed").collect()
    clean, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.05 * len(junk)


def test_accuracies_are_found_again():
    """Votes drawn from known chances, counted, give these chances back."""
    rng = np.random.default_rng(5)
    good = rng.random(200_000) < 0.85
    of_good, of_bad = np.array([0.98, 0.95, 0.99, 0.9, 0.97]), np.array([0.3, 0.5, 0.2, 0.6, 0.4])
    votes = np.where(rng.random((len(good), 5)) < np.where(good[:, None], of_good, of_bad), 1, -1)
    votes[rng.random(votes.shape) < 0.2] = 0
    distinct, count = np.unique(votes, axis=0, return_counts=True)
    w = rules.weigh(distinct, count.astype(float))
    assert abs(w.prior - 0.85) < 0.01
    assert np.abs(w.of_good - of_good).max() < 0.01 and np.abs(w.of_bad - of_bad).max() < 0.03
    known = rules.Weights(0.85, of_good, of_bad, 0)
    assert ((w.posterior(votes) >= 0.5) == (known.posterior(votes) >= 0.5)).mean() > 0.99


def _check_whitened(rows, vectors, components=4, scale=256):
    """Against all eigenpairs of the whole covariance; deviations in Python's whole numbers."""
    x = {i: [math.floor(scale * c) for c in v] for i, v in vectors}
    each = [list(v) for v in sorted({tuple(v) for v in x.values()})]
    n, sums = len(each), [sum(column) for column in zip(*each)]
    values, q = np.linalg.eigh(np.cov(np.array(each, float).T, bias=True))
    values, q = values[::-1], q[:, ::-1]
    mean = np.array(sums) / n
    assert len(rows) == len(vectors) * components
    for j in range(components):
        own = {r.vec_id: r for r in rows if r.component == j + 1}
        want = {i: float((np.array(v) - mean) @ q[:, j] / np.sqrt(values[j])) for i, v in x.items()}
        largest = max(want, key=lambda i: abs(want[i]))
        sign = math.copysign(1, want[largest] * own[largest].whitened)
        for i, r in own.items():
            assert r.whitened == pytest.approx(sign * want[i], rel=1e-9, abs=1e-9)
            assert (r.n, r.deviation) == (n, sum((n * a - s) ** 2 for a, s in zip(x[i], sums)))
            assert r.explained == pytest.approx(values[j] / values.sum(), rel=1e-10)
            assert r.identity_error <= 1e-9


def test_whitening_of_the_given_vectors(spark):
    rows = contract.queries()["op13_filtered_whitening"](spark, FOLDER).collect()
    _check_whitened(rows, [v for v in _vectors(spark) if _fit_for_use(v[1])])


def test_whitening_adds_up_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "AT_DRIVER", 1)
    vectors = [(i, v) for i, v in _vectors(spark) if _fit_for_use(v)][:200]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.openCostInBytes")}
    for k, v in zip(before, ("false", "134217728")):
        spark.conf.set(k, v)
    try:
        found = whitening.Vectors(whitening.usable(frame, 256, "vec_id", "embedding"), 64)
        assert found.tasks >= 4
        _check_whitened(whitening.whiten(frame).collect(), vectors)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    points = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(60, 5)) * [9, 5, 3, 2, 1])]
    points += [(100 + i, points[0][1]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    odd = [(500, None), (501, []), (502, [1.0]), (503, [nan] * 5), (504, [inf] * 5), (505, [None] * 5), (506, [1e300] * 5)]
    frame = spark.createDataFrame(
        [(i, v, 1, "y") for i, v in points + odd], "vec_id long, embedding array<double>, n int, Whitened string")
    _check_whitened(whitening.whiten(frame).collect(), points)
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.where("vec_id in (500, 501)")).collect() == []
    alone = whitening.whiten(frame.where("vec_id >= 100 and vec_id < 140")).collect()
    assert len(alone) == 160 and all(r.whitened is None and r.n == 1 and r.deviation == 0 for r in alone)
    assert all(r.explained is None and r.identity_error is None for r in alone)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    for r in whitening.whiten(flat).collect():
        assert (r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9


class _Held:
    def __init__(self, x):
        self.x, self.dims = x - x.mean(0), x.shape[1]

    def times(self, q):
        return self.x.T @ (self.x @ q) / len(self.x), float((self.x ** 2).sum() / len(self.x))


@pytest.mark.parametrize("dims, n", [(300, 1000), (64, 2000), (400, 50)])
def test_leading_pairs_in_fewer_passes_than_dimensions(dims, n):
    x = np.random.default_rng(dims).normal(size=(n, dims)) * np.r_[12, 11, 10, 9, np.ones(dims - 4)]
    found = whitening.leading(_Held(x))
    values, q = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(found.values, values[::-1][:4], rtol=1e-12)
    assert np.allclose(np.abs((found.vectors * q[:, ::-1][:, :4]).sum(0)), 1, atol=1e-12)
    assert found.passes < 64

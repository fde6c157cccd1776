"""Language, quality and toxicity: held-out accuracy, and the rows no model has seen."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import language, queries, quality, toxicity
from touchline.llm.machine import Rows, fit

FOLDER = "/root/testdata/sf0.01"
ODD = [
    (1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, "1234 !?", "de"), (None, "of the and that", None),
    (6, "the of and " * 30_000, None), (7, "the of and", "en"), (7, "the of and", "en"), (8, "\u0000 é \U0001f600", "fr"),
]
SCHEMA = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_language_on_held_out_documents(spark, docs):
    found = queries.queries()["op1_language_network"](spark, FOLDER)
    assert found.count() == docs.count()
    held = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.95
    assert held.score.between(0, 1).all()


def test_language_of_odd_rows(spark, docs):
    net = language.train(docs)
    odd = spark.createDataFrame(ODD, SCHEMA).withColumn("Score", F.lit("mine"))
    rows = language.with_language(odd, net).collect()
    assert len(rows) == len(ODD) and rows[0].__fields__ == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [(r.lang_pred, r.score) for r in rows[:4]] == [("und", 0.0)] * 4
    assert rows[4].lang_pred == "en" and rows[5].lang_pred == "en"
    assert rows[6] == rows[7] and rows[8].lang_pred in net.langs


def test_language_without_labels(spark):
    odd = spark.createDataFrame(ODD, SCHEMA)
    net = language.train(odd.where("false"))
    assert net is None
    assert {(r.lang_pred, r.score) for r in language.with_language(odd, net).collect()} == {("und", 0.0)}
    assert language.with_language(odd.where("false"), net).count() == 0


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 253 * 4 + 3, 253 * 4 + 4, 5000):
        rows = language.windows("a" * n)
        assert rows.shape[1] == language.WINDOW
        # Neighbours overlap by one byte less than the widest filter, so that each of its places is seen.
        assert (rows > 0).sum() == n + (len(rows) - 1) * (max(language.WIDTHS) - 1)


@pytest.mark.parametrize("name,label,least", [("op5_quality_machine", "quality", 0.9), ("op6_toxicity_machine", "toxic", 0.75)])
def test_machines_on_held_out_documents(spark, docs, labels, name, label, least):
    found = queries.queries()[name](spark, FOLDER)
    assert found.count() == docs.count()
    held = found.where("held_out").join(labels, "doc_id").toPandas()
    truth, score = held[label].to_numpy() == 1, held.score.to_numpy()
    order = np.argsort(np.argsort(score))
    auc = (order[truth].mean() - (truth.sum() - 1) / 2) / (~truth).sum()
    assert auc > least
    assert ((score >= (0.3 if label == "quality" else 0.5)) == (held.predicted == 1)).all()


@pytest.mark.parametrize("module,add", [(quality, quality.with_quality), (toxicity, toxicity.with_toxicity)])
def test_machines_on_odd_rows(spark, docs, labels, module, add):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumn("SCORE", F.lit(True))
    rows = add(odd, module.train(docs, labels)).collect()
    assert [r.doc_id for r in rows] == [r[0] for r in ODD] and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score and rows[6] == rows[7]
    none = module.train(docs, labels.where("false"))
    assert {r.score for r in add(odd, none).collect()} == {0.5}
    assert add(odd.where("false"), none).count() == 0


def test_contradicting_and_null_labels(spark):
    docs = spark.createDataFrame([(i, f"good word{i}" if i % 2 else f"bad word{i}") for i in range(60)], "doc_id long, text string")
    marks = [(i, i % 2) for i in range(60)] + [(0, 1), (None, 1), (3, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = quality.with_quality(docs, quality.train(docs, labels)).toPandas()
    assert found.score[found.doc_id % 2 == 1].min() > found.score[(found.doc_id % 2 == 0) & (found.doc_id > 0)].max()


def test_machine_learns_a_pair_that_no_weight_tells():
    """Label 1 only where both features are there, or neither: beyond any sum of weights."""
    rng = np.random.default_rng(1)
    parts, labels = [], []
    for _ in range(1200):
        a, b = rng.integers(0, 2, 2)
        ids = np.array([0 if a else 1, 2 if b else 3])
        parts.append((ids, np.ones(2)))
        labels.append(float(a == b))
    rows = Rows.of(parts)
    machine = fit(rows, np.array(labels, np.float32), 4, epochs=60)
    assert ((machine.score(rows) > 0.5) == np.array(labels)).mean() > 0.95


def test_linear_time_sum_equals_all_pairs():
    rng = np.random.default_rng(2)
    rows = Rows.of([(rng.choice(30, 5, replace=False), rng.normal(size=5)) for _ in range(20)] + [(np.zeros(0, int), np.zeros(0))])
    machine = fit(rows, (rng.random(21) > 0.5).astype(np.float32), 30, least=1)
    for r in range(21):
        ids = machine.place[rows.ids[rows.starts[r]:rows.starts[r + 1]]]
        x = rows.values[rows.starts[r]:rows.starts[r + 1]] * machine.scale[ids]
        pairs = sum(machine.v[ids[i]] @ machine.v[ids[j]] * x[i] * x[j] for i in range(len(ids)) for j in range(i))
        assert machine.logit(rows)[r] == pytest.approx(machine.w0 + machine.w[ids] @ x + pairs, abs=1e-4)

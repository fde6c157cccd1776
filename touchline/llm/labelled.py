"""A bounded sample of labelled documents, and scoring by a machine fitted on it.

Shared by the quality and the toxicity classifier, which differ in their features.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.batches import ROWS, add_columns
from touchline.llm.machine import Machine, Rows, fit

Features = Callable[[list], Rows]


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, learn=None) -> DataFrame:
    """At most ``rows`` labelled documents: ``doc_id``, the columns of ``docs`` and ``label`` 0 or 1.

    They are those of the smallest hashes of ``doc_id``, of the ids for which ``learn`` holds. Rows
    with a null id or label teach nothing; where an id has several labels, the more frequent counts, a
    tie as 1.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.avg(label).alias("mean"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = known.select("doc_id", (F.col("mean") >= 0.5).cast("int").alias("_label"))
    # Broadcast: it holds `rows` ids at most.
    return docs.join(F.broadcast(known), "doc_id").withColumnRenamed("_label", "label")


def learn(examples: DataFrame, text: str, start: Callable[[], Features], size: int, rows: int, **fitting) -> Machine:
    """Features of ``examples`` (text, ``label``) made on the executors, and a machine fitted on the driver.

    The driver gets ``rows`` sparse rows at most, those of the smallest text hashes; repeated ids can
    make ``examples`` larger than the sample of labels.
    """
    def of(texts_to_rows):
        def compute(texts):
            r = texts_to_rows(texts)
            cut = range(len(r))
            return [
                pa.array([r.ids[r.starts[i]:r.starts[i + 1]].astype(np.int32) for i in cut], pa.list_(pa.int32())),
                pa.array([r.values[r.starts[i]:r.starts[i + 1]] for i in cut], pa.list_(pa.float32())),
            ]
        return compute

    found = add_columns(
        examples.select(text, "label", F.xxhash64(text, "label").alias("place")),
        text, {"ids": "array<int>", "xs": "array<float>"}, lambda: of(start()),
    )
    table = found.select("label", "ids", "xs", "place").orderBy("place").limit(rows).toArrow()
    parts = [
        (np.asarray(i.values, np.int64), np.asarray(x.values, np.float32))
        for i, x in zip(table["ids"], table["xs"], strict=True)
    ]
    return fit(Rows.of(parts), np.array(table["label"].to_pylist(), np.float32), size, **fitting)


def scored(docs: DataFrame, text: str, machine: Machine, start: Callable[[], Features], column: str) -> DataFrame:
    """``docs`` with the machine's score of each whole text as a double."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # bounded by the number of buckets

    def begin():
        model = sent.value
        features = start(model)
        return lambda texts: [pa.array(model.score(features(texts)), pa.float64())]

    return add_columns(docs, text, {column: "double"}, begin)


__all__ = ["ROWS", "learn", "sample", "scored"]

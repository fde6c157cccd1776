"""Columns computed from a text column in Arrow batches, all other columns passed through."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROWS = 256
LETTERS = 1 << 20
"""Rows, and characters beyond the first text, handed to a function at once."""


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = str(Path(__file__).resolve().parents[2])


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver does, however the driver was started."""
    path = spark.sparkContext.environment
    if _ROOT not in path.get("PYTHONPATH", "").split(os.pathsep):
        path["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, path.get("PYTHONPATH")]))


def _short_batches(spark: SparkSession) -> None:
    """Batches of 1,000 rows where the session has Spark's default of 10,000, which for long texts is much."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")


def pieces(texts: list) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of at most ``ROWS`` rows and ``LETTERS`` characters, or of one text."""
    at = size = 0
    for i, text in enumerate(texts):
        more = len(text) if text else 0
        if i > at and (i - at >= ROWS or size + more > LETTERS):
            yield at, i
            at, size = i, 0
        size += more
    if at < len(texts):
        yield at, len(texts)


def without(df: DataFrame, names) -> DataFrame:
    """``df`` less the columns of these names in any case, so that new ones can take their place."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def add_columns(
    df: DataFrame, text: str, fields: dict[str, str], start: Callable[[], Callable[[list], list[pa.Array]]]
) -> DataFrame:
    """``df`` with the columns of ``fields`` (name to Spark type) behind its own.

    ``start()`` runs once per task and returns the function that takes the texts of up to ``ROWS``
    rows (``None`` where null) and returns an Arrow array for each new column. Columns of ``df`` that
    clash with a new name give way to it.
    """
    _short_batches(df.sparkSession)
    kept = without(df, fields)
    position = kept.columns.index(text)
    added = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    schema = StructType([*kept.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for whole in batches:
            texts = whole.column(position).to_pylist()
            for at, end in pieces(texts):
                batch = whole.slice(at, end - at)
                new = compute(texts[at:end])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *new], names=[*batch.schema.names, *fields]
                )

    return kept.mapInArrow(run, schema)

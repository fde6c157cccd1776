"""Ad-hoc SQL over the flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(**tables: DataFrame) -> None:
    """Name DataFrames for ``spark.sql``: ``register_views(events=..., matches=...)``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

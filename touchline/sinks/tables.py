"""The transformed zone (flat Parquet) and the curated results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The column each transformed table is laid out by. Reports ask for one kind of event
# or one season, so they read those folders only.
LAYOUT = {
    "competitions": [],
    "matches": ["season_id"],
    "lineups": [],
    "events": ["event_type_name"],
}


def write_transformed(df: DataFrame, root: str, name: str, mode: str = "overwrite", batch: int | None = None) -> None:
    """Write a flat table as Parquet, in folders by ``LAYOUT[name]``; with a ``batch``, below a folder of its own.

    The rebalance gathers a folder's rows into files of the advisory partition size: AQE splits a
    kind of event that holds a third of all rows and merges the rare ones, so neither one huge file
    nor one sliver per input file comes out.
    """
    folders = LAYOUT[name]
    rows = df.hint("rebalance", *folders) if folders else df.hint("rebalance")
    below = "" if batch is None else f"/batch_id={batch}"
    rows.write.mode(mode).partitionBy(*folders).parquet(f"{root}/{name}{below}")


def read_transformed(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Read a transformed table. A ``schema`` fixes the folder column's type, else Spark guesses it.

    With a ``schema`` the number of the batch that wrote a row is left out.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(f"{root}/{name}")
    return table if schema is None else table.select(*schema.names)


def write_curated(
    df: DataFrame,
    name: str,
    root: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    **options: str,
) -> None:
    """Replace the result ``name``.

    With a ``root`` it is the folder ``root/name``. Without, ``fmt`` is a connector that finds its
    place by options, and the name is passed as its ``collection``.
    """
    writer = df.write.format(fmt).mode(mode)
    if root is not None:
        writer.options(**options).save(f"{root}/{name}")
    else:
        writer.options(**{"collection": name, **options}).save()


def read_curated(spark: SparkSession, name: str, root: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root}/{name}")

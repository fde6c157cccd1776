"""Nested records to flat tables. All lazy projections: no shuffle, and columns prune through them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from touchline import schemas


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pick ``columns`` (new name -> path into nested fields)."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])


def competitions(df: DataFrame) -> DataFrame:
    return project(df, schemas.COMPETITION_COLUMNS)


def matches(df: DataFrame) -> DataFrame:
    """One row per match; ``match_date`` becomes a date, NULL where the text is not one."""
    return project(df, schemas.MATCH_COLUMNS).withColumn(
        "match_date", F.col("match_date").try_cast("date")
    )


def lineups(df: DataFrame, outer: bool = False) -> DataFrame:
    """One row per listed player. Teams without players vanish, unless ``outer`` keeps them."""
    players = (F.inline_outer if outer else F.inline)("lineup")
    return project(df.select("team_id", "team_name", players), schemas.LINEUP_COLUMNS)


def _typed(whole: Column, schema: StructType, path: str = "$") -> Column:
    """The fields of ``schema`` out of a variant; NULL where they are absent or of another kind."""
    return F.struct(*[
        (_typed(whole, field.dataType, f"{path}.{field.name}") if isinstance(field.dataType, StructType)
         else F.try_variant_get(whole, f"{path}.{field.name}", field.dataType.simpleString())).alias(field.name)
        for field in schema
    ])


def events(df: DataFrame) -> DataFrame:
    """The columns all events share, and those of each kind.

    ``pass``, ``shot`` and ``dribble`` are structs of the fields that reports ask for, which prune and
    filter in Parquet. Beside them ``pass_whole`` and so on hold all that the raw record had.
    """
    structs = {
        kind: F.when(F.col(f"{kind}_whole").isNotNull(), _typed(F.col(f"{kind}_whole"), schema))
        for kind, schema in schemas.TYPED.items()
    }
    return project(df, schemas.EVENT_COLUMNS).withColumns(structs)


def parse_scores(
    df: DataFrame, value: str | Column = "value", schema: StructType = schemas.SCORES
) -> DataFrame:
    """JSON payloads to columns. Malformed text gives a row of NULLs."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return df.select(F.from_json(text, schema).alias("data")).select("data.*")

"""Readers of the raw zone (nested JSON) and of static dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from touchline import schemas

# Where each kind of file lies below the raw zone's root.
LAYOUT = {
    "competitions": "competitions.json",
    "matches": "matches/*/*.json",
    "lineups": "lineups/*.json",
    "events": "events/*.json",
}
# The text of a record that could not be read, NULL for others, and the file that a record is from.
BAD, FILE = "_corrupt_record", "_file"
# An events file is named by the match it belongs to.
_MATCH_FILE = r"/(\d+)\.json[^/]*$"


def _json(
    spark: SparkSession, path: str | list[str], schema: StructType, multiline: bool, mode: str, stream: bool = False
) -> DataFrame:
    """Records with ``BAD`` and ``FILE`` beside their own columns.

    Of a multi-line file that is cut short nothing can be read: its whole text is one bad record.
    A ``stream`` gives each file once, as long as its checkpoint is kept.
    """
    fields = StructType([*schema.fields, StructField(BAD, StringType())])
    reader = (spark.readStream if stream else spark.read).schema(fields)
    read = reader.json(path, multiLine=multiline, mode=mode, columnNameOfCorruptRecord=BAD)
    return read.withColumn(FILE, F.col("_metadata.file_path"))


def read_competitions(
    spark: SparkSession, path: str | list[str], multiline: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    return _json(spark, path, schemas.COMPETITIONS, multiline, mode)


def read_matches(
    spark: SparkSession, path: str | list[str], multiline: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    return _json(spark, path, schemas.MATCHES, multiline, mode)


def read_lineups(
    spark: SparkSession, path: str | list[str], multiline: bool = True, mode: str = "PERMISSIVE",
    stream: bool = False,
) -> DataFrame:
    return _json(spark, path, schemas.LINEUPS, multiline, mode, stream)


def read_events(
    spark: SparkSession, path: str | list[str], multiline: bool = True, mode: str = "PERMISSIVE",
    stream: bool = False,
) -> DataFrame:
    """Events; ``match_id`` comes from the record, else from the name of its file.

    ``multiline=False`` reads one record per line, which splits large files. A pretty-printed array
    needs ``multiline=True``: read by line, it would give a row of NULLs for each line. ``mode`` is
    Spark's: ``FAILFAST`` stops at malformed text.
    """
    raw = _json(spark, path, schemas.EVENTS, multiline, mode, stream)
    from_name = F.regexp_extract(FILE, _MATCH_FILE, 1).try_cast("long")
    return raw.withColumn("match_id", F.coalesce("match_id", from_name))


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    """The static team dimension."""
    return spark.read.parquet(path)

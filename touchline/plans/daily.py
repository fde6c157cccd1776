"""The daily run: raw JSON to flat Parquet once, then every report from the Parquet."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from touchline import functions as flat, schemas
from touchline.plans import partials
from touchline.plans.jobs import REPORTS, Tables
from touchline.sinks import read_transformed, write_curated, write_transformed
from touchline.sources import LAYOUT, read_competitions, read_events, read_lineups, read_matches
from touchline.sources.raw import BAD, FILE

# Raw reader, its schema, and the projection to the flat table.
_ZONES = {
    "competitions": (read_competitions, schemas.COMPETITIONS, flat.competitions),
    "matches": (read_matches, schemas.MATCHES, flat.matches),
    "lineups": (read_lineups, schemas.LINEUPS, flat.lineups),
    "events": (read_events, schemas.EVENTS, flat.events),
}


# What joins know a record by.
_KEYS = {"competitions": "competition_id", "matches": "match_id", "lineups": "team_id", "events": "match_id"}


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file fits the pattern, in whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def teams(matches: DataFrame, competitions: DataFrame) -> DataFrame:
    """``team_name`` with the ``country`` and ``stadium`` of most of its home matches, for the live job."""
    lands = competitions.select("competition_id", "season_id", F.col("country_name").alias("country")).distinct()
    home = matches.select("competition_id", "season_id", F.col("home_team_name").alias("team_name"),
                          F.col("stadium_name").alias("stadium"))
    found = home.where("team_name IS NOT NULL").join(lands, ["competition_id", "season_id"], "left")
    return found.groupBy("team_name").agg(
        F.mode("country", True).alias("country"), F.mode("stadium", True).alias("stadium")
    )


def flat_schema(spark: SparkSession, name: str) -> StructType:
    _, schema, flatten = _ZONES[name]
    return flatten(spark.createDataFrame([], schema)).schema


def flat_from_raw(
    spark: SparkSession, raw: str, name: str, multiline: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    """The readable records of a raw table, flat."""
    read, _, flatten = _ZONES[name]
    return flatten(read(spark, f"{raw}/{LAYOUT[name]}", multiline, mode).where(F.col(BAD).isNull()))


class TooManyRejects(RuntimeError):
    """More of a raw table could not be read than the run allows."""


def transform(
    spark: SparkSession, raw: str, silver: str, names: Iterable[str] = ("competitions", "matches", "events"),
    multiline: bool = True, mode: str = "PERMISSIVE", max_rejects: float = 0.01,
) -> dict[str, dict[str, int]]:
    """Read each raw table once, write it flat, and count its ``rows``, ``rejects`` and those ``without_key``.

    What cannot be read goes to ``silver/rejects/<name>`` with the name of its file; beyond a share of
    ``max_rejects`` of the records the run fails, after that. A record without a key is kept, but no join
    finds it. The counts come with the write; only bad records cost a second reading.
    """
    counts = {}
    for name in names:
        read, _, flatten = _ZONES[name]
        found = read(spark, f"{raw}/{LAYOUT[name]}", multiline, mode)
        good, seen = F.col(BAD).isNull(), Observation()
        observed = found.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(BAD).alias("rejects"),
            F.count_if(good & F.col(_KEYS[name]).isNull()).alias("without_key"),
        )
        write_transformed(flatten(observed.where(good)), silver, name)
        counts[name] = seen.get
        rejects = spark.createDataFrame([], "file string, text string")
        if counts[name]["rejects"]:
            # Spark reads no raw file for the sake of bad text alone, hence the key, which is NULL here.
            text = F.coalesce(F.col(BAD), F.col(_KEYS[name]).cast("string"))
            rejects = found.where(~good).select(F.col(FILE).alias("file"), text.alias("text"))
        rejects.write.mode("overwrite").parquet(f"{silver}/rejects/{name}")
        if counts[name]["rejects"] > max_rejects * counts[name]["rows"]:
            raise TooManyRejects(f"{counts[name]['rejects']} of {counts[name]['rows']} records of {name}; see {silver}/rejects/{name}")
    return counts


# Raw tables of a file per match, written once. Other files are replaced as a season goes on.
ONCE_PER_MATCH = ("lineups", "events")


def ingest(
    spark: SparkSession, raw: str, silver: str, checkpoint: str, names: Iterable[str] = ONCE_PER_MATCH,
    multiline: bool = True, mode: str = "PERMISSIVE", max_rejects: float = 0.01,
) -> dict[str, dict[str, int]]:
    """Add the raw files that have come since the last run, and no others, to the flat tables; counts as of ``transform``.

    ``checkpoint/<name>`` remembers which files have been read, by name: a file that is replaced is not read again, so
    this is for ``ONCE_PER_MATCH``. Each batch of files owns ``silver/<name>/batch_id=<n>`` and
    ``silver/rejects/<name>/batch_id=<n>`` and overwrites them, so a batch that Spark repeats after a failure changes nothing.
    Too many rejects among the new records fail the run when all are stored; the next run goes on behind them.
    A silver table belongs to either ``ingest`` or ``transform``. Batches of events that have no ``partials`` yet are folded.
    """
    counts = {}
    for name in names:
        read, _, flatten = _ZONES[name]
        found = read(spark, f"{raw}/{LAYOUT[name]}", multiline, mode, stream=True)
        seen = counts[name] = dict.fromkeys(("rows", "rejects", "without_key"), 0)

        def write(batch: DataFrame, number: int, name=name, flatten=flatten, seen=seen) -> None:
            good, observed = F.col(BAD).isNull(), Observation()
            counted = batch.observe(
                observed, F.count(F.lit(1)).alias("rows"), F.count(BAD).alias("rejects"),
                F.count_if(good & F.col(_KEYS[name]).isNull()).alias("without_key"),
            )
            write_transformed(flatten(counted.where(good)), silver, name, batch=number)
            for key, n in observed.get.items():
                seen[key] += n
            rejects = batch.where(~good).select(F.col(FILE).alias("file"), F.col(BAD).alias("text"))
            if not observed.get["rejects"]:
                rejects = spark.createDataFrame([], rejects.schema)
            rejects.write.mode("overwrite").parquet(f"{silver}/rejects/{name}/batch_id={number}")

        stream = found.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{name}")
        stream.trigger(availableNow=True).start().awaitTermination()
        if name == "events":
            for number in partials.missing(spark, silver):
                batch = read_transformed(spark, silver, f"events/batch_id={number}", flat_schema(spark, "events"))
                partials.store(batch, silver, number)
        if seen["rejects"] > max_rejects * seen["rows"]:
            raise TooManyRejects(f"{seen['rejects']} of {seen['rows']} new records of {name}; see {silver}/rejects/{name}")
    return counts


def tables_of(spark: SparkSession, silver: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_transformed(spark, silver, name, flat_schema(spark, name)) for name in names}


def run_all(
    spark: SparkSession,
    raw: str,
    silver: str,
    curated: str | None = None,
    names: Iterable[str] = tuple(REPORTS),
    multiline: bool = True,
    mode: str = "PERMISSIVE",
    max_rejects: float = 0.01,
    checkpoint: str | None = None,
    **sink: str,
) -> dict[str, dict[str, int]]:
    """The whole daily run. ``curated`` and ``sink`` go to ``write_curated``; the counts are ``transform``'s.

    Lineups are written flat too, where there are any, and the teams of all matches. With a ``checkpoint`` the files of
    ``ONCE_PER_MATCH`` go through ``ingest``, so only new ones are read; their counts are of these. Reports then come from
    the kept partials where these answer them.
    """
    found = [name for name in _ZONES if name != "lineups" or exists(spark, f"{raw}/{LAYOUT[name]}")]
    new = [name for name in found if checkpoint is not None and name in ONCE_PER_MATCH]
    counts = transform(spark, raw, silver, [name for name in found if name not in new], multiline, mode, max_rejects)
    if new:
        counts |= ingest(spark, raw, silver, checkpoint, new, multiline, mode, max_rejects)
    flat_tables = Tables(**tables_of(spark, silver, Tables._fields))
    kept = partials.stored(spark, silver) if new else None
    for name in names:
        merged = kept is not None and name in partials.REPORTS
        result = partials.REPORTS[name](kept, flat_tables) if merged else REPORTS[name](flat_tables)
        write_curated(result, name, curated, **sink)
    teams(flat_tables.matches, flat_tables.competitions).write.mode("overwrite").parquet(f"{silver}/teams")
    return counts

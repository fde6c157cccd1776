"""Counts and sums by match, team, player and position, kept between daily runs and merged into reports.

Each batch of new events is folded once, to some fifty rows a match, and its rows own the folder
``partials/batch_id=<n>``; a batch that is repeated overwrites them. Partials merge by addition, so a match whose
events come in several batches counts whole, and a day's work is its new events and the small table. All reports
but the assists, which link single events, come from them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.functions import flag, share
from touchline.operators import diff_from_mean, growth, lagged, ranked, running, sum_through, top_n, with_competition, with_match
from touchline.plans.jobs import Tables, _kind, _result

NAME = "partials"
GROUP = ("match_id", "team_name", "player_name", "position_name")


def _measures() -> dict[str, Column]:
    passed, shot = _kind("Pass"), _kind("Shot")
    done, cross, xg = F.col("pass.outcome.name").isNull(), F.col("pass.cross"), F.col("shot.statsbomb_xg")
    return {
        "passes": flag(passed),
        "passes_done": flag(passed & done),
        "crosses": flag(passed & cross),
        "crosses_done": flag(passed & cross & done),
        "shots": flag(shot),
        "goals": flag(shot & _result("shot", "Goal")),
        "xg_shots": flag(shot & xg.isNotNull()),
        "xg": F.when(shot, xg),
        "dribbles": flag(_kind("Dribble") & _result("dribble", "Complete")),
        "counterpress": flag(F.col("counterpress")),
        "timed": flag(F.col("duration").isNotNull()),
        "duration": F.col("duration"),
    }


def fold(events: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """The partials of ``events``: a row per ``group`` with a column per measure. Summed as they are read."""
    return events.groupBy(*group).agg(*[F.sum(value).alias(name) for name, value in _measures().items()])


def store(events: DataFrame, root: str, batch: int, group: Sequence[str] = GROUP) -> None:
    """Fold the events of batch ``batch`` into its own folder; once more changes nothing."""
    fold(events, group).write.mode("overwrite").parquet(f"{root}/{NAME}/batch_id={batch}")


def stored(spark: SparkSession, root: str) -> DataFrame:
    """The partials of all batches; groups that several batches share have a row for each."""
    return spark.read.parquet(f"{root}/{NAME}").drop("batch_id")


def _batches(spark: SparkSession, table: str, file: str = "") -> set[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/batch_id=*{file}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or ()
    folders = [f.getPath().getParent() if file else f.getPath() for f in found]
    return {int(f.getName().split("=")[1]) for f in folders}


def missing(spark: SparkSession, root: str, table: str = "events") -> list[int]:
    """Batches of ``table`` without whole partials: those from before there were any, or of a run that failed between."""
    return sorted(_batches(spark, f"{root}/{table}") - _batches(spark, f"{root}/{NAME}", "/_SUCCESS"))


def _sums(partials: DataFrame, by: Sequence[str], where: str, **names: str) -> DataFrame:
    """Sums of the measure ``where`` and others by group, of groups that have any of the first."""
    rows = partials.where(F.col(where) > 0)
    return rows.groupBy(*by).agg(*[F.sum(measure).alias(name) for name, measure in names.items()])


def top_scorers(partials: DataFrame, player: str = "player_name", n: int = 10) -> DataFrame:
    """As ``jobs.top_scorers``."""
    goals = _sums(partials, [player], "goals", total="goals").withColumnRenamed("total", "goals")
    return top_n(goals, "goals", [player], n).select(player, "goals", "rank")


def pass_completion(
    partials: DataFrame, matches: DataFrame, team: str = "team_name", n: int | None = 5
) -> DataFrame:
    """As ``jobs.pass_completion``."""
    sums = _sums(partials, ["match_id", team], "passes", total="passes", successful="passes_done")
    rates = sums.select("match_id", team, share(F.col("successful"), F.col("total")).alias("completion_rate"))
    means = running(
        with_match(rates, matches, ["match_date"]), [team], ["match_date", "match_id"], "completion_rate", "avg", n,
        "running_avg_completion",
    )
    return means.select(team, "match_date", "completion_rate", "running_avg_completion")


def xg_rank(
    partials: DataFrame, matches: DataFrame, competitions: DataFrame, player: str = "player_name",
    digits: int | None = 12, top: int | None = None,
) -> DataFrame:
    """As ``jobs.xg_rank``; means are rounded there too, as sums of doubles depend on their order."""
    named = with_competition(matches, competitions, ["competition_name"])
    sums = sum_through(
        partials.where("xg_shots > 0"), named, "match_id", [player], ["competition_name"], fold=False,
        xg=F.col("xg"), shots=F.col("xg_shots"),
    )
    means = sums.select(player, "competition_name", share(F.col("xg"), F.col("shots"), digits).alias("avg_xg"))
    return ranked(
        means, ["competition_name"], "avg_xg", [player], "dense", name="rank_in_comp", top=top, bounded=True
    ).select(player, "competition_name", "avg_xg", "rank_in_comp")


def dribbles_vs_previous(
    partials: DataFrame, matches: DataFrame, player: str = "player_name", season: str = "season_id"
) -> DataFrame:
    """As ``jobs.dribbles_vs_previous``."""
    counts = sum_through(
        partials.where("dribbles > 0"), matches, "match_id", [player], [season], fold=False, dribbles=F.col("dribbles")
    )
    return lagged(counts, [player], [season], "dribbles", "prev_season_dribbles").select(
        player, season, "dribbles", "prev_season_dribbles"
    )


def conversion_by_position(
    partials: DataFrame, matches: DataFrame, competitions: DataFrame, ascending: bool = False
) -> DataFrame:
    """As ``jobs.conversion_by_position``."""
    named = with_competition(matches, competitions, [F.col("competition_name").alias("league")])
    shots = partials.where((F.col("shots") > 0) & F.col("position_name").isNotNull())
    sums = sum_through(
        shots, named, "match_id", ["position_name"], ["league"], fold=False, shots=F.col("shots"), goals=F.col("goals")
    )
    rates = sums.withColumn("conversion_rate", share(F.col("goals"), F.col("shots")))
    return ranked(
        rates, ["league"], "conversion_rate", ["position_name"], "percent", ascending, "percentile_rank", bounded=True
    ).select("league", "position_name", "shots", "goals", "conversion_rate", "percentile_rank")


def counterpress(
    partials: DataFrame, matches: DataFrame, team: str = "team_name", n: int | None = 5
) -> DataFrame:
    """As ``jobs.counterpress``."""
    counts = _sums(partials, ["match_id", team], "counterpress", counterpress_events="counterpress")
    means = running(
        with_match(counts, matches, ["match_date"]), [team], ["match_date", "match_id"], "counterpress_events", "avg", n,
        "rolling_avg_counterpress",
    )
    return means.select(team, "match_date", "counterpress_events", "rolling_avg_counterpress")


def duration_vs_league(partials: DataFrame, team: str = "team_name") -> DataFrame:
    """As ``jobs.duration_vs_league``, but for the last bits of the means, whose sums are of sums."""
    sums = _sums(partials, [team], "timed", total="duration", rows="timed")
    means = sums.select(team, share(F.col("total"), F.col("rows")).alias("team_avg_duration"))
    return diff_from_mean(means, "team_avg_duration", "league_avg_duration", "diff_from_league_avg")


def cross_rank(
    partials: DataFrame, matches: DataFrame, team: str = "team_name", season: str = "season_id", top: int | None = None
) -> DataFrame:
    """As ``jobs.cross_rank``."""
    sums = sum_through(
        partials.where("crosses > 0"), matches, "match_id", [team], [season],
        crosses=F.col("crosses"), done=F.col("crosses_done"),
    )
    rates = sums.select(team, season, share(F.col("done"), F.col("crosses")).alias("cross_completion"))
    return ranked(
        rates, [season], "cross_completion", [team], "rank", name="rank_in_season", top=top, bounded=True
    ).select(team, season, "cross_completion", "rank_in_season")


def goals_growth(
    partials: DataFrame, matches: DataFrame, competitions: DataFrame, season: str = "season_id"
) -> DataFrame:
    """As ``jobs.goals_growth``."""
    named = with_competition(matches, competitions, ["competition_name"])
    goals = sum_through(
        partials.where("goals > 0"), named, "match_id", [], ["competition_name", season], goals=F.col("goals")
    )
    return growth(
        goals, ["competition_name"], [season], "goals", "prev_season_goals", "yoy_growth"
    ).select("competition_name", season, "goals", "prev_season_goals", "yoy_growth")


# Collection -> report over the partials and the flat tables, for those of ``jobs.REPORTS`` that partials answer.
REPORTS: dict[str, Callable[[DataFrame, Tables], DataFrame]] = {
    "top_goalscorers": lambda p, t: top_scorers(p),
    "pass_completion_running_avg": lambda p, t: pass_completion(p, t.matches),
    "avg_xg_per_player": lambda p, t: xg_rank(p, t.matches, t.competitions),
    "dribbles_with_lag": lambda p, t: dribbles_vs_previous(p, t.matches),
    "position_conversion_percentile": lambda p, t: conversion_by_position(p, t.matches, t.competitions),
    "counterpress_rolling_avg": lambda p, t: counterpress(p, t.matches),
    "possession_duration_diff": lambda p, t: duration_vs_league(p),
    "cross_completion_rank": lambda p, t: cross_rank(p, t.matches),
    "goals_yoy_growth": lambda p, t: goals_growth(p, t.matches, t.competitions),
}

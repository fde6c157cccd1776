"""The ten reports, from flat tables to a result table each.

Teams and players are told apart by the columns named in ``team`` and ``player``; the defaults are
their names, and an id column keeps namesakes apart. ``season`` is the column seasons are ordered by.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.functions import flag, share
from touchline.operators import (
    completion_rate,
    count_by,
    diff_from_mean,
    growth,
    lagged,
    linked_pairs,
    mean_by,
    ranked,
    running,
    sum_through,
    top_n,
    with_competition,
    with_match,
)


def _kind(name: str) -> Column:
    return F.col("event_type_name") == name


def _result(kind: str, name: str) -> Column:
    return F.col(f"{kind}.outcome.name") == name


def _goals(events: DataFrame) -> DataFrame:
    return events.where(_kind("Shot") & _result("shot", "Goal"))


def top_scorers(events: DataFrame, player: str = "player_name", n: int = 10) -> DataFrame:
    """The ``n`` players with the most goals; equal counts go by name."""
    goals = count_by(_goals(events), [player], "goals")
    return top_n(goals, "goals", [player], n).select(player, "goals", "rank")


def pass_completion(
    events: DataFrame, matches: DataFrame, team: str = "team_name", n: int | None = 5
) -> DataFrame:
    """Share of completed passes by team and match, and its mean over the team's last ``n`` matches.

    A pass without an outcome was completed. ``n=None`` averages since the team's first match.
    """
    rates = completion_rate(
        events,
        ["match_id", team],
        F.col("pass.outcome.name").isNull(),
        where=_kind("Pass"),
        names=("total_passes", "successful_passes", "completion_rate"),
    )
    dated = with_match(rates.select("match_id", team, "completion_rate"), matches, ["match_date"])
    means = running(
        dated, [team], ["match_date", "match_id"], "completion_rate", "avg", n, "running_avg_completion"
    )
    return means.select(team, "match_date", "completion_rate", "running_avg_completion")


def xg_rank(
    events: DataFrame,
    matches: DataFrame,
    competitions: DataFrame,
    player: str = "player_name",
    digits: int | None = 12,
    top: int | None = None,
) -> DataFrame:
    """Mean expected goals per shot by player, ranked without gaps within the competition.

    Means are ranked as rounded to ``digits``; unrounded, equal means could differ in their last bits
    by the order of addition, and their ranks from run to run. A competition has as many rows as
    players, so a plain window ranks them.
    """
    shots = events.where(_kind("Shot") & F.col("shot.statsbomb_xg").isNotNull())
    named = with_competition(matches, competitions, ["competition_name"])
    sums = sum_through(
        shots,
        named,
        "match_id",
        [player],
        ["competition_name"],
        fold=False,
        xg=F.col("shot.statsbomb_xg"),
        shots=F.lit(1),
    )
    means = sums.select(
        player, "competition_name", share(F.col("xg"), F.col("shots"), digits).alias("avg_xg")
    )
    return ranked(
        means, ["competition_name"], "avg_xg", [player], "dense", name="rank_in_comp", top=top, bounded=True
    ).select(player, "competition_name", "avg_xg", "rank_in_comp")


def dribbles_vs_previous(
    events: DataFrame, matches: DataFrame, player: str = "player_name", season: str = "season_id"
) -> DataFrame:
    """Completed dribbles by player and season, next to the player's previous season."""
    done = events.where(_kind("Dribble") & _result("dribble", "Complete"))
    counts = sum_through(done, matches, "match_id", [player], [season], fold=False, dribbles=F.lit(1))
    return lagged(counts, [player], [season], "dribbles", "prev_season_dribbles").select(
        player, season, "dribbles", "prev_season_dribbles"
    )


def assist_pairs(
    events: DataFrame,
    matches: DataFrame,
    player: str = "player_name",
    fn: str = "count",
    n: int | None = 10,
) -> DataFrame:
    """Goals by passer and scorer, and how many of the pair's last ``n`` assists there were by then."""
    passes = events.where(_kind("Pass") & F.col("pass.goal_assist")).select(
        "match_id", "event_id", F.col(player).alias("passer"), F.col("pass.assisted_shot_id").alias("shot_ref")
    )
    goals = _goals(events).select(F.col("event_id").alias("shot_id"), F.col(player).alias("scorer"))
    pairs = with_match(linked_pairs(passes, goals, "shot_ref", "shot_id"), matches, ["match_date"])
    counts = running(
        pairs.select("passer", "scorer", "match_date", "match_id", "event_id", F.lit(1).alias("one")),
        ["passer", "scorer"],
        ["match_date", "match_id", "event_id"],
        "one",
        fn,
        n,
        "assists_last_10",
    )
    return counts.select("passer", "scorer", "match_date", "assists_last_10")


def conversion_by_position(
    events: DataFrame, matches: DataFrame, competitions: DataFrame, ascending: bool = False
) -> DataFrame:
    """Shots, goals and conversion rate by position, with the percent rank within the league."""
    shots = events.where(_kind("Shot") & F.col("position_name").isNotNull())
    named = with_competition(matches, competitions, [F.col("competition_name").alias("league")])
    sums = sum_through(
        shots,
        named,
        "match_id",
        ["position_name"],
        ["league"],
        fold=False,
        shots=F.lit(1),
        goals=flag(_result("shot", "Goal")),
    )
    rates = sums.withColumn("conversion_rate", share(F.col("goals"), F.col("shots")))
    return ranked(
        rates, ["league"], "conversion_rate", ["position_name"], "percent", ascending, "percentile_rank",
        bounded=True,
    ).select("league", "position_name", "shots", "goals", "conversion_rate", "percentile_rank")


def counterpress(
    events: DataFrame, matches: DataFrame, team: str = "team_name", n: int | None = 5
) -> DataFrame:
    """Counter-pressing events by team and match, and their mean over the last ``n`` such matches."""
    counts = count_by(events, ["match_id", team], "counterpress_events", where=F.col("counterpress"))
    dated = with_match(counts, matches, ["match_date"])
    means = running(
        dated, [team], ["match_date", "match_id"], "counterpress_events", "avg", n, "rolling_avg_counterpress"
    )
    return means.select(team, "match_date", "counterpress_events", "rolling_avg_counterpress")


def duration_vs_league(events: DataFrame, team: str = "team_name") -> DataFrame:
    """Mean event duration by team against the mean of those means, each team weighing the same."""
    means = mean_by(events, [team], "duration", "team_avg_duration")
    return diff_from_mean(means, "team_avg_duration", "league_avg_duration", "diff_from_league_avg")


def possession_vs_league(events: DataFrame, team: str = "possession_team_name") -> DataFrame:
    """Mean duration of a possession by team, against the mean of those means.

    A possession lasts as long as its events together, those without a duration counting as none.
    """
    each = events.where(F.col("duration").isNotNull()).groupBy("match_id", "possession", team).agg(
        F.sum("duration").alias("lasted")
    )
    means = mean_by(each, [team], "lasted", "team_avg_duration")
    return diff_from_mean(means, "team_avg_duration", "league_avg_duration", "diff_from_league_avg")


def counterpress_turnovers(
    events: DataFrame, matches: DataFrame, team: str = "team_name", holder: str = "possession_team_name",
    order: str = "index", n: int | None = 5,
) -> DataFrame:
    """Counter-pressing events that win the ball, by team and match, and their mean over such matches.

    The ball is won where the other side holds it and the next event of the match belongs to a
    possession of the pressing team. A match has no more events than it lasts, so a plain window looks
    ahead.
    """
    ahead = F.lead(holder).over(Window.partitionBy("match_id").orderBy(order))
    won = F.col("counterpress") & (F.col(holder) != F.col(team)) & (F.col("_next_holder") == F.col(team))
    seen = events.select("match_id", team, holder, order, "counterpress").withColumn("_next_holder", ahead)
    counts = count_by(seen, ["match_id", team], "turnovers", where=won)
    dated = with_match(counts, matches, ["match_date"])
    means = running(dated, [team], ["match_date", "match_id"], "turnovers", "avg", n, "rolling_avg_turnovers")
    return means.select(team, "match_date", "turnovers", "rolling_avg_turnovers")


def cross_rank(
    events: DataFrame,
    matches: DataFrame,
    team: str = "team_name",
    season: str = "season_id",
    top: int | None = None,
    fold: bool = True,
) -> DataFrame:
    """Share of completed crosses by team and season, ranked within the season.

    ``fold`` is that of ``sum_through``: worth its shuffle where a match has many crosses of a team.
    """
    crosses = events.where(_kind("Pass") & F.col("pass.cross"))
    sums = sum_through(
        crosses,
        matches,
        "match_id",
        [team],
        [season],
        fold,
        crosses=F.lit(1),
        successful_crosses=flag(F.col("pass.outcome.name").isNull()),
    )
    rates = sums.select(
        team, season, share(F.col("successful_crosses"), F.col("crosses")).alias("cross_completion")
    )
    return ranked(
        rates, [season], "cross_completion", [team], "rank", name="rank_in_season", top=top, bounded=True
    ).select(team, season, "cross_completion", "rank_in_season")


def goals_growth(
    events: DataFrame, matches: DataFrame, competitions: DataFrame, season: str = "season_id"
) -> DataFrame:
    """Goals by competition and season, and their growth over the season before."""
    named = with_competition(matches, competitions, ["competition_name"])
    goals = sum_through(
        _goals(events), named, "match_id", [], ["competition_name", season], goals=F.lit(1)
    )
    return growth(
        goals, ["competition_name"], [season], "goals", "prev_season_goals", "yoy_growth"
    ).select("competition_name", season, "goals", "prev_season_goals", "yoy_growth")


class Tables(NamedTuple):
    """The flat tables the reports read."""

    events: DataFrame
    matches: DataFrame
    competitions: DataFrame


# Collection -> report.
REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "top_goalscorers": lambda t: top_scorers(t.events),
    "pass_completion_running_avg": lambda t: pass_completion(t.events, t.matches),
    "avg_xg_per_player": lambda t: xg_rank(*t),
    "dribbles_with_lag": lambda t: dribbles_vs_previous(t.events, t.matches),
    "assist_combinations": lambda t: assist_pairs(t.events, t.matches),
    "position_conversion_percentile": lambda t: conversion_by_position(*t),
    "counterpress_rolling_avg": lambda t: counterpress(t.events, t.matches),
    "possession_duration_diff": lambda t: duration_vs_league(t.events),
    "cross_completion_rank": lambda t: cross_rank(t.events, t.matches),
    "goals_yoy_growth": lambda t: goals_growth(*t),
}

"""Live scores: enrichment from static dimensions, and watermarked windows.

Spark aggregates each micro-batch within its reading tasks before the shuffle, so a team or match
that holds a third of the stream arrives at the state store as one row per window and task.

Scores are running totals, polled over and over. The sums below add what was polled; they count a
goal once per poll, not once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.session import pin

DELAY = "1 minute"


def one_per_key(dimension: DataFrame, key: str) -> DataFrame:
    """One row per ``key``, always the same one. A second would double window sums.

    The row with the most columns filled speaks for its key; of several, the smallest as JSON text, which
    orders columns of any type.
    """
    rest = [F.col(c) for c in dimension.columns if c != key]
    if not rest:
        return dimension.distinct()
    filled = sum((c.isNotNull().cast("int") for c in rest), F.lit(0))
    row = F.struct(*rest)
    return dimension.groupBy(key).agg(
        F.min_by(row, F.struct((-filled).alias("empty"), F.to_json(row).alias("text"))).alias("_row")
    ).select(key, "_row.*")


def enrich(scores: DataFrame, teams: DataFrame, on: str = "home_team", key: str = "team_name") -> DataFrame:
    """Add the team's columns; scores of unknown teams stay, with NULLs.

    ``teams`` is reduced to one row per key and written here, once and outside the stream, so each
    micro-batch joins a table as it lies.
    """
    return scores.join(pin(one_per_key(teams, key)), F.col(on) == F.col(key), "left_outer")


def attach_player(
    scores: DataFrame, players: DataFrame, on: str, key: str = "player_id", goal: Column | None = None
) -> DataFrame:
    """Goal events with the player's columns from the lineups. ``goal`` says which rows are goals."""
    return enrich(scores if goal is None else scores.where(goal), players, on, key)


def tumbling_avg(
    scores: DataFrame,
    by: str = "home_team",
    value: str = "home_score",
    name: str = "avg_home_goals",
    time: str = "timestamp",
    size: str = "10 minutes",
    delay: str = DELAY,
) -> DataFrame:
    """Mean of ``value`` by team in windows side by side."""
    return (
        scores.withWatermark(time, delay)
        .groupBy(F.window(time, size), by)
        .agg(F.avg(value).alias(name))
    )


def high_scoring(
    scores: DataFrame,
    by: str = "match_id",
    home: str = "home_score",
    away: str = "away_score",
    threshold: float = 4,
    name: str = "total_goals",
    time: str = "timestamp",
    size: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = DELAY,
) -> DataFrame:
    """Sliding windows of matches whose scores sum to more than ``threshold``."""
    return (
        scores.withWatermark(time, delay)
        .groupBy(F.window(time, size, slide), by)
        .agg((F.sum(home) + F.sum(away)).alias(name))
        .where(F.col(name) > threshold)
    )


def team_form(
    scores: DataFrame,
    by: str = "home_team",
    scored: str = "home_score",
    conceded: str = "away_score",
    time: str = "timestamp",
    size: str = "30 minutes",
    slide: str = "5 minutes",
    delay: str = DELAY,
) -> DataFrame:
    """Goals scored and conceded by team in sliding windows."""
    return (
        scores.withWatermark(time, delay)
        .groupBy(F.window(time, size, slide), by)
        .agg(F.sum(scored).alias("goals_scored"), F.sum(conceded).alias("goals_conceded"))
    )

"""Explicit schemas of the raw zone and the columns each flat table takes from it.

Absent fields read as NULL, and no pass over the data is spent on inference.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_long, _text, _double, _flag = LongType(), StringType(), DoubleType(), BooleanType()
_named = _struct(id=_long, name=_text)
_outcome = _struct(name=_text)

COMPETITIONS = _struct(
    competition_id=_long,
    season_id=_long,
    competition_name=_text,
    competition_gender=_text,
    country_name=_text,
    season_name=_text,
)

MATCHES = _struct(
    match_id=_long,
    match_date=_text,
    kick_off=_text,
    home_score=_long,
    away_score=_long,
    match_week=_long,
    competition_stage=_named,
    competition=_struct(id=_long),
    season=_struct(id=_long),
    home_team=_named,
    away_team=_named,
    stadium=_named,
    referee=_named,
    metadata=_struct(data_version=_text),
)

PLAYER = _struct(
    player_id=_long,
    player_name=_text,
    player_nickname=_text,
    jersey_number=_long,
    country=_named,
)
LINEUPS = _struct(team_id=_long, team_name=_text, lineup=ArrayType(PLAYER))

# Event kinds no report looks into; kept whole.
OPAQUE = [
    "carry",
    "duel",
    "block",
    "clearance",
    "interception",
    "foul_committed",
    "foul_won",
    "goalkeeper",
    "bad_behaviour",
    "substitution",
    "tactics",
]

PASS = StructType([
    StructField("outcome", _outcome),
    StructField("assisted_shot_id", _text),
    StructField("goal_assist", _flag),
    StructField("cross", _flag),
])
SHOT = _struct(statsbomb_xg=_double, outcome=_outcome)
DRIBBLE = _struct(outcome=_outcome)
# Kinds the reports look into: read whole, with the fields the reports ask for as typed columns beside.
TYPED = {"pass": PASS, "shot": SHOT, "dribble": DRIBBLE}

EVENTS = StructType([
    StructField("match_id", _long),
    StructField("id", _text),
    StructField("index", _long),
    StructField("period", _long),
    StructField("timestamp", _text),
    StructField("minute", _long),
    StructField("second", _long),
    StructField("type", _named),
    StructField("possession", _long),
    StructField("possession_team", _named),
    StructField("play_pattern", _named),
    StructField("team", _named),
    StructField("player", _named),
    StructField("position", _named),
    StructField("location", ArrayType(_double)),
    StructField("duration", _double),
    StructField("under_pressure", _flag),
    StructField("off_camera", _flag),
    StructField("out", _flag),
    StructField("counterpress", _flag),
    StructField("related_events", ArrayType(_text)),
    *[StructField(name, VariantType()) for name in (*TYPED, *OPAQUE)],
])

# The fields of a score payload.
SCORES = StructType([
    StructField("match_id", _text),
    StructField("home_team", _text),
    StructField("away_team", _text),
    StructField("home_score", IntegerType()),
    StructField("away_score", IntegerType()),
    StructField("minute", IntegerType()),
    StructField("timestamp", TimestampType()),
])

# Flat column -> path in the raw record. A renamed raw field is one edit here.
COMPETITION_COLUMNS = {name: name for name in COMPETITIONS.names}
MATCH_COLUMNS = {
    "match_id": "match_id",
    "match_date": "match_date",
    "kick_off": "kick_off",
    "home_score": "home_score",
    "away_score": "away_score",
    "match_week": "match_week",
    "competition_stage_id": "competition_stage.id",
    "competition_stage_name": "competition_stage.name",
    "competition_id": "competition.id",
    "season_id": "season.id",
    "home_team_id": "home_team.id",
    "home_team_name": "home_team.name",
    "away_team_id": "away_team.id",
    "away_team_name": "away_team.name",
    "stadium_id": "stadium.id",
    "stadium_name": "stadium.name",
    "referee_id": "referee.id",
    "referee_name": "referee.name",
    "data_version": "metadata.data_version",
}
LINEUP_COLUMNS = {
    "team_id": "team_id",
    "team_name": "team_name",
    "player_id": "player_id",
    "player_name": "player_name",
    "player_nickname": "player_nickname",
    "jersey_number": "jersey_number",
    "country_id": "country.id",
    "country_name": "country.name",
}
EVENT_COLUMNS = {
    "match_id": "match_id",
    "event_id": "id",
    "index": "index",
    "period": "period",
    "timestamp": "timestamp",
    "minute": "minute",
    "second": "second",
    "event_type_id": "type.id",
    "event_type_name": "type.name",
    "possession": "possession",
    "possession_team_id": "possession_team.id",
    "possession_team_name": "possession_team.name",
    "play_pattern_id": "play_pattern.id",
    "play_pattern_name": "play_pattern.name",
    "team_id": "team.id",
    "team_name": "team.name",
    "player_id": "player.id",
    "player_name": "player.name",
    "position_id": "position.id",
    "position_name": "position.name",
    "location": "location",
    "duration": "duration",
    "under_pressure": "under_pressure",
    "off_camera": "off_camera",
    "out": "out",
    "counterpress": "counterpress",
    "related_events": "related_events",
    **{f"{name}_whole": name for name in TYPED},
    **{name: name for name in OPAQUE},
}

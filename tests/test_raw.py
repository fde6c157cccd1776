"""Raw zone to flat tables."""

import pytest
from conftest import rows
from football import competition, event, match, named, passed, shot
from pyspark.sql import functions as F

from touchline import functions as flat, schemas
from touchline.sources import (
    read_competitions, read_events, read_lineups, read_matches, read_teams, register_views,
)


def test_pretty_printed_array_is_two_rows(spark, dump):
    path = dump("competitions.json", [competition("Cup", 1), competition("League", 2)])
    df = flat.competitions(read_competitions(spark, path, mode="FAILFAST"))
    assert rows(df) == [
        (1, 1, "Cup", "female", "Nowhere", "2001"),
        (1, 2, "League", "female", "Nowhere", "2002"),
    ]
    assert df.columns == list(schemas.COMPETITION_COLUMNS)


def test_matches_two_folders_deep(spark, dump):
    dump("matches/2/44.json", [match(7, "2019-08-09", 44, 2)])
    path = dump("matches/9/1.json", [match(8, "no date", 1, 9)])
    df = flat.matches(read_matches(spark, path.replace("9/1.json", "*/*.json")))
    assert df.columns == list(schemas.MATCH_COLUMNS)
    assert rows(df, "match_id", F.col("match_date").cast("string"), "competition_id", "season_id") == [
        (7, "2019-08-09", 2, 44), (8, None, 9, 1),
    ]
    assert rows(df.where("match_id = 7"), "home_team_name", "away_team_id", "referee_name", "data_version",
                "competition_stage_name", "stadium_id", "match_week") == [
        ("Reds", 11, "R. Fair", "1.1.0", "Final", 5, 3),
    ]


def test_lineups_without_players(spark, dump):
    player = {
        "player_id": 1, "player_name": "Ann", "player_nickname": None, "jersey_number": 9,
        "country": named("Chile", 3),
    }
    path = dump("lineups/7.json", [
        {"team_id": 10, "team_name": "Reds", "lineup": [player, {**player, "player_id": 2, "country": None}]},
        {"team_id": 11, "team_name": "Blues", "lineup": []},
        {"team_id": 12, "team_name": "Greens", "lineup": None},
    ])
    raw = read_lineups(spark, path)
    assert rows(flat.lineups(raw)) == [
        (10, "Reds", 1, "Ann", None, 9, 3, "Chile"),
        (10, "Reds", 2, "Ann", None, 9, None, None),
    ]
    assert rows(flat.lineups(raw, outer=True), "team_id", "player_id") == [
        (10, 1), (10, 2), (11, None), (12, None),
    ]


def test_match_id_from_record_or_file_name(spark, dump):
    dump("events/15946.json", [event("Pass"), event("Shot")])
    dump("events/22.json", [event("Pass", match_id=99)])
    path = dump("events/notes.json", [event("Pass")])
    df = flat.events(read_events(spark, path.replace("notes.json", "*.json")))
    assert rows(df, "match_id", "event_type_name") == [
        (None, "Pass"), (99, "Pass"), (15946, "Pass"), (15946, "Shot"),
    ]


def test_event_columns(spark, dump):
    full = event(
        "Pressure", key="abc", index=4, period=1, timestamp="00:00:01.500", minute=0, second=1, possession=2,
        possession_team=named("Blues", 11), play_pattern=named("From Kick Off", 9),
        position=named("Left Back", 6), location=[61.0, 40.5], duration=0.75, under_pressure=True, out=False,
        counterpress=True, related_events=["x", "y"], duel={"type": {"id": 11, "name": "Tackle"}},
    )
    path = dump("events/5.json", [full, shot("Saved", 0.25), passed("Out", cross=True)])
    df = flat.events(read_events(spark, path))
    assert df.columns == [*schemas.EVENT_COLUMNS, *schemas.TYPED]
    assert rows(
        df.where("event_id = 'abc'"), "match_id", "index", "possession_team_id", "possession_team_name",
        "play_pattern_name", "position_id", "position_name", "duration", "under_pressure", "out", "counterpress",
    ) == [(5, 4, 11, "Blues", "From Kick Off", 6, "Left Back", 0.75, True, False, True)]
    first = df.where("event_id = 'abc'").first()
    assert (first["location"], first["related_events"]) == ([61.0, 40.5], ["x", "y"])
    tackle = F.try_variant_get("duel", "$.type.name", "string")
    assert rows(df, tackle) == [(None,), (None,), ("Tackle",)]
    assert rows(df, "shot.statsbomb_xg", "shot.outcome.name") == [(None, None), (None, None), (0.25, "Saved")]
    assert rows(df, "pass.cross", "pass.outcome.name") == [(None, None), (None, None), (True, "Out")]


def test_field_missing_from_every_file(spark, dump):
    df = flat.events(read_events(spark, dump("events/5.json", [event("Pass"), event("Shot")])))
    assert rows(df, "off_camera", "tactics", "counterpress") == [(None, None, None)] * 2


def test_one_record_per_line(spark, dump, tmp_path):
    import json

    path = tmp_path / "3.json"
    path.write_text("\n".join(json.dumps(event("Pass")) for _ in range(3)))
    assert flat.events(read_events(spark, str(path), multiline=False)).where("match_id = 3").count() == 3


def test_failfast_stops_at_malformed_text(spark, tmp_path):
    path = tmp_path / "1.json"
    path.write_text('[{"id": "a"')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_events(spark, str(path), mode="FAILFAST").collect()


def test_malformed_score_is_a_row_of_nulls(spark):
    good = '{"match_id":"m","home_team":"Reds","away_team":"Blues","home_score":2,"away_score":1,' \
           '"minute":70,"timestamp":"2024-01-01T10:00:00Z"}'
    raw = spark.createDataFrame([(good.encode(),), (b"{bad",)], "value binary")
    assert rows(flat.parse_scores(raw), "match_id", "home_score", F.col("timestamp").cast("string")) == [
        (None, None, None), ("m", 2, "2024-01-01 10:00:00"),
    ]


def test_teams_and_views(spark, tmp_path):
    path = str(tmp_path / "teams.parquet")
    spark.createDataFrame([("Reds", "Chile", "The Park")], "team_name string, country string, stadium string") \
        .write.parquet(path)
    register_views(teams=read_teams(spark, path))
    assert rows(spark.sql("SELECT country FROM teams WHERE team_name = 'Reds'")) == [("Chile",)]

"""Zones, the whole daily run, ad-hoc SQL over its tables, and the shared folder."""

import pytest
from conftest import rows
from football import competition, dribble, event, match, passed, shot
from pyspark.sql import functions as F

from touchline import session
from touchline.__main__ import main
from touchline.plans import daily, jobs
from touchline.sinks import read_curated, read_transformed, write_curated, write_transformed
from touchline.sources import register_views


@pytest.fixture
def raw(dump, tmp_path):
    for m in (1, 2):
        dump(f"events/{m}.json", [
            passed(assisted_shot_id=f"s{m}", goal_assist=True, cross=True),
            passed("Out", cross=True, team="Blues"),
            shot(key=f"s{m}", player="Bea", position={"id": 1, "name": "Wing"}),
            dribble(),
            event("50/50", duration=1.5, counterpress=True, duel={"type": {"name": "x"}}),
            {**event("Half Start"), "type": None},
        ])
    dump("matches/1/1.json", [match(1, "2020-01-01", season=1)])
    dump("matches/1/2.json", [match(2, "2021-01-01", season=2)])
    dump("competitions.json", [competition("Cup", 1), competition("Cup", 2)])
    return str(tmp_path)


def test_daily_run_from_json_to_curated(spark, raw, tmp_path):
    silver, curated = f"{raw}/silver", f"{raw}/curated"
    for _ in range(2):  # a second run replaces the first
        daily.run_all(spark, raw, silver, curated)
    direct = jobs.Tables(*[daily.flat_from_raw(spark, raw, name) for name in jobs.Tables._fields])
    for name, report in jobs.REPORTS.items():
        stored = read_curated(spark, name, curated)
        assert rows(stored) == rows(report(direct)), name
        assert stored.count() > 0, name


def test_command_line(spark, raw, tmp_path):
    main(["daily", "--raw", raw, "--silver", f"{raw}/s", "--out", f"{raw}/c", "--report", "goals_yoy_growth"])
    assert rows(read_curated(spark, "goals_yoy_growth", f"{raw}/c"), "goals") == [(1,), (1,)]

    payload = '{"match_id":"m","home_team":"Reds","home_score":5,"away_score":1,"timestamp":"2024-01-01T%s:00Z"}'
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "1.txt").write_text(f"{payload % '10:00'}\n{payload % '12:00'}")
    spark.createDataFrame([("Reds", "Chile")], "team_name string, country string").write.parquet(f"{raw}/teams")
    main(["live", "--source", "text", "--source-option", f"path={raw}/feed", "--teams", f"{raw}/teams",
          "--checkpoint", f"{raw}/state", "--out", f"{raw}/live", "--once"])
    assert spark.read.parquet(f"{raw}/live/high_scoring_alerts").count() == 5


def test_transformed_events_keep_every_row_and_prune(spark, raw):
    daily.transform(spark, raw, f"{raw}/silver", ["events"])
    events = daily.tables_of(spark, f"{raw}/silver", ["events"])["events"]
    assert events.count() == 12
    assert rows(events.select("event_type_name").distinct()) == [
        (None,), ("50/50",), ("Dribble",), ("Pass",), ("Shot",),
    ]
    plan = jobs.top_scorers(events)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type_name" in plan
    assert "statsbomb_xg" not in plan  # columns prune to the leaf


def test_whole_structs_survive_beside_typed_fields(spark, dump, tmp_path):
    record = passed("Out", cross=True)
    record["pass"] |= {"length": 12.5, "recipient": {"id": 7, "name": "Bea"}, "body_part": {"name": "Left Foot"}}
    dump("events/1.json", [record, event("Pass", **{"pass": None})])
    daily.transform(spark, str(tmp_path), f"{tmp_path}/silver", ["events"])
    events = daily.tables_of(spark, f"{tmp_path}/silver", ["events"])["events"]
    whole = [F.try_variant_get("pass_whole", *x) for x in (("$.length", "double"), ("$.recipient.name", "string"), ("$.body_part.name", "string"))]
    assert rows(events, "pass.outcome.name", "pass.cross", *whole) == [
        (None, None, None, None, None), ("Out", True, 12.5, "Bea", "Left Foot"),
    ]
    plan = events.where("pass.outcome.name = 'Out'").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pass.outcome.name,Out)" in plan and "pass_whole" not in plan


def test_bad_files_go_to_the_rejects(spark, raw, tmp_path):
    (tmp_path / "events" / "3.json").write_text('[{"id": "a", "type": {"id": 1, "name": "Pass"}}, {"id": "b"')
    (tmp_path / "events" / "notes.json").write_text('[{"id": "c", "type": {"id": 1, "name": "Pass"}}]')
    counts = daily.transform(spark, raw, f"{raw}/silver", ["events"], max_rejects=0.5)
    assert counts == {"events": {"rows": 14, "rejects": 1, "without_key": 1}}
    assert daily.tables_of(spark, f"{raw}/silver", ["events"])["events"].count() == 13
    (reject,) = spark.read.parquet(f"{raw}/silver/rejects/events").collect()
    assert reject.file.endswith("events/3.json") and '"id": "b"' in reject.text
    with pytest.raises(daily.TooManyRejects, match="1 of 14"):
        daily.transform(spark, raw, f"{raw}/silver", ["events"])
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        main(["daily", "--raw", raw, "--silver", f"{raw}/f", "--out", f"{raw}/c", "--mode", "FAILFAST"])


def test_daily_run_leaves_lineups_and_teams(spark, raw, dump):
    player = {"player_id": 1, "player_name": "Ann", "jersey_number": 9, "country": {"id": 3, "name": "Chile"}}
    dump("lineups/1.json", [{"team_id": 10, "team_name": "Reds", "lineup": [player]}])
    counts = daily.run_all(spark, raw, f"{raw}/silver", f"{raw}/curated", ["top_goalscorers"])
    assert counts["lineups"]["rows"] == 1 and counts["events"]["rejects"] == 0
    assert rows(read_transformed(spark, f"{raw}/silver", "lineups"), "player_name") == [("Ann",)]
    assert rows(spark.read.parquet(f"{raw}/silver/teams")) == [("Reds", "Nowhere", "The Park")]


def test_lineups_zone(spark, dump, tmp_path):
    player = {"player_id": 1, "player_name": "Ann", "jersey_number": 9, "country": {"id": 3, "name": "Chile"}}
    dump("lineups/1.json", [{"team_id": 10, "team_name": "Reds", "lineup": [player]}])
    daily.transform(spark, str(tmp_path), f"{tmp_path}/silver", ["lineups"])
    assert rows(read_transformed(spark, f"{tmp_path}/silver", "lineups"), "team_id", "player_name") == [(10, "Ann")]


def test_sql_over_views_equals_the_report(spark, raw):
    tables = {n: daily.flat_from_raw(spark, raw, n) for n in jobs.Tables._fields}
    register_views(**tables)
    sql = spark.sql("""
        WITH goals AS (
            SELECT competition_name, season_id, count(*) AS goals
            FROM events JOIN matches USING (match_id) JOIN competitions USING (competition_id, season_id)
            WHERE event_type_name = 'Shot' AND shot.outcome.name = 'Goal' GROUP BY ALL)
        SELECT *, lag(goals) OVER (PARTITION BY competition_name ORDER BY season_id) AS before FROM goals
    """)
    report = jobs.goals_growth(**tables)
    assert rows(sql) == rows(report, "competition_name", "season_id", "goals", "prev_season_goals")


def test_hot_kind_is_rebalanced_by_folder(spark, tmp_path):
    df = spark.range(300).selectExpr("id AS match_id", "if(id % 3 = 0, 'Pass', concat('k', id % 30)) AS event_type_name")
    write_transformed(df, str(tmp_path), "events")
    assert len(list((tmp_path / "events" / "event_type_name=Pass").glob("*.parquet"))) == 1
    assert read_transformed(spark, str(tmp_path), "events").count() == 300


def test_curated_to_a_connector(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    for _ in range(2):
        write_curated(df, "result", fmt="json", path=str(tmp_path / "docs"))
    assert rows(spark.read.json(str(tmp_path / "docs")), "k", "v") == [(1, "a")]


def test_pinned_rows_outlive_their_source(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "source"))
    pinned = session.pin(spark.read.parquet(str(tmp_path / "source")))
    for file in (tmp_path / "source").iterdir():
        file.unlink()
    assert pinned.count() == 5
    assert session.scratch(spark, "x") != session.scratch(spark, "x")


def test_shared_folder_must_be_named_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "spark://host", "app"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session)
    Session.sparkContext.master = "local[2]"
    assert session.shared_dir(Session) == session.shared_dir(Session)

"""The ten reports on small inputs with answers worked out by hand."""

import pytest
from conftest import rows
from football import competition, dribble, event, match, passed, shot
from pyspark.sql import functions as F

from touchline import functions as flat
from touchline.plans import jobs
from touchline.sources import read_competitions, read_events, read_matches, star


@pytest.fixture
def load(spark, dump, tmp_path):
    """Flat tables from {match id: events}, matches and competitions."""

    def make(events, matches=(), competitions=(competition(),)):
        for match_id, records in events.items():
            dump(f"events/{match_id}.json", records)
        dump("matches/1/1.json", list(matches) or [match(m) for m in events])
        dump("competitions.json", list(competitions))
        return jobs.Tables(
            flat.events(read_events(spark, f"{tmp_path}/events/*.json")),
            flat.matches(read_matches(spark, f"{tmp_path}/matches/*/*.json")),
            flat.competitions(read_competitions(spark, f"{tmp_path}/competitions.json")),
        )

    return make


def test_top_scorers_with_a_tie_at_the_end(load):
    goals = [shot(player=f"p{i:02d}") for i in range(11) for _ in range(max(12 - i, 3))]
    t = load({1: [*goals, shot("Saved", player="p99"), event("Foul", player="p99"), *[shot(player="p10")] * 0]})
    out = jobs.top_scorers(t.events).collect()
    # 12, 11, ... 4, then p09 and p10 with three goals each: the name decides.
    assert [tuple(r) for r in out] == [(f"p{i:02d}", 12 - i, i + 1) for i in range(10)]


def test_top_scorers_ids_keep_namesakes_apart(load):
    twin = lambda key: {**shot(), "player": {"id": key, "name": "Ann"}}
    t = load({1: [twin(1), twin(1), twin(2)]})
    assert rows(jobs.top_scorers(t.events)) == [("Ann", 3, 1)]
    assert rows(jobs.top_scorers(t.events, player="player_id")) == [(1, 2, 1), (2, 1, 2)]


def test_pass_without_outcome_was_completed(load):
    t = load({1: [passed(), passed(), passed("Incomplete"), shot()]}, [match(1, "2020-05-01")])
    (row,) = jobs.pass_completion(t.events, t.matches).collect()
    assert (row[0], str(row[1])) == ("Reds", "2020-05-01")
    assert row[2] == row[3] == pytest.approx(2 / 3)


def test_pass_completion_over_five_matches(load):
    # Rates 1, 0, 1, 0, 1, 0 on six days, given out of order; a match without a match row is dropped.
    order = {30: 1, 10: 2, 20: 3, 60: 4, 50: 5, 40: 6}
    t = load(
        {**{m: [passed(None if day % 2 else "Out")] for m, day in order.items()}, 99: [passed()]},
        [match(m, f"2020-01-0{day}") for m, day in order.items()],
    )
    out = rows(jobs.pass_completion(t.events, t.matches), "match_date", "running_avg_completion")
    assert [r for _, r in out] == pytest.approx([1, 1 / 2, 2 / 3, 1 / 2, 3 / 5, 2 / 5])
    since = rows(jobs.pass_completion(t.events, t.matches, n=None), "match_date", "running_avg_completion")
    assert [r for _, r in since] == pytest.approx([1, 1 / 2, 2 / 3, 1 / 2, 3 / 5, 1 / 2])


def test_xg_rank(load):
    t = load(
        {
            1: [shot(xg=0.9, player="A"), shot(xg=0.1, player="A"), shot(xg=0.5, player="B"), shot(xg=0.2, player="C")],
            2: [shot(xg=0.1, player="C"), shot(xg=None, player="D")],
        },
        [match(1, competition=1), match(2, competition=2)],
        [competition("Cup", key=1), competition("League", key=2)],
    )
    out = jobs.xg_rank(*t, digits=9)
    assert rows(out) == [
        ("A", "Cup", 0.5, 1), ("B", "Cup", 0.5, 1), ("C", "Cup", 0.2, 2), ("C", "League", 0.1, 1),
    ]
    assert rows(jobs.xg_rank(*t, digits=9, top=1), "player_name") == [("A",), ("B",), ("C",)]


def test_dribbles_against_the_season_before(load):
    t = load(
        {
            1: [dribble(), dribble(), dribble("Incomplete"), dribble(player="Bea")],
            2: [dribble()],
            3: [dribble()],
        },
        [match(1, season=1), match(2, season=2), match(3, season=2)],
    )
    assert rows(jobs.dribbles_vs_previous(t.events, t.matches)) == [
        ("Ann", 1, 2, None), ("Ann", 2, 2, 2), ("Bea", 1, 1, None),
    ]


def test_assist_pairs_last_ten(load):
    events = {
        m: [
            passed(assisted_shot_id=f"s{m}", goal_assist=True, player="Ann"),
            shot(key=f"s{m}", player="Bea"),
        ]
        for m in range(1, 12)
    }
    # A goal assist whose shot was saved, a pass that assisted no goal, a dangling reference.
    events[12] = [
        passed(assisted_shot_id="s12", goal_assist=True), shot("Saved", key="s12"),
        passed(assisted_shot_id="s13"), shot(key="s13"),
        passed(assisted_shot_id="nowhere", goal_assist=True),
    ]
    t = load(events, [match(m, f"2020-01-{m:02d}") for m in events])
    out = jobs.assist_pairs(t.events, t.matches)
    assert rows(out.drop("match_date")) == [("Ann", "Bea", n) for n in (*range(1, 11), 10)]
    eleven = jobs.assist_pairs(t.events, t.matches, fn="sum", n=11)
    assert rows(eleven.drop("match_date"))[-1] == ("Ann", "Bea", 11)


def test_two_assists_in_one_match_count_twice(load):
    pair = lambda key: [passed(assisted_shot_id=key, goal_assist=True), shot(key=key, player="Bea")]
    t = load({1: pair("a") + pair("b")})
    assert rows(jobs.assist_pairs(t.events, t.matches), "assists_last_10") == [(1,), (2,)]


def test_conversion_by_position(load):
    at = lambda position, outcome: shot(outcome, position={"id": 1, "name": position})
    t = load({1: [
        at("Wing", "Goal"), at("Wing", "Saved"), at("Back", "Saved"), at("Striker", "Goal"), shot("Goal"),
    ]})
    assert rows(jobs.conversion_by_position(*t)) == [
        ("Cup", "Back", 1, 0, 0.0, 1.0),
        ("Cup", "Striker", 1, 1, 1.0, 0.0),
        ("Cup", "Wing", 2, 1, 0.5, 0.5),
    ]
    up = jobs.conversion_by_position(*t, ascending=True)
    assert rows(up, "position_name", "percentile_rank") == [("Back", 0.0), ("Striker", 1.0), ("Wing", 0.5)]


def test_counterpress_counts_true_only(load):
    t = load(
        {1: [event("Pressure", counterpress=True)] * 3 + [event("Pressure"), event("Duel", counterpress=False)],
         2: [event("Duel", counterpress=True)], 3: [event("Pass")]},
        [match(1, "2020-01-01"), match(2, "2020-01-02"), match(3, "2020-01-03")],
    )
    assert rows(jobs.counterpress(t.events, t.matches).drop("match_date")) == [("Reds", 1, 2.0), ("Reds", 3, 3.0)]


def test_duration_against_mean_of_means(load):
    t = load({1: [
        event("Carry", duration=1.0), event("Carry", duration=3.0), event("Pass"),
        *[event("Carry", team="Blues", duration=4.0)] * 5, event("Pass", team="Greens"),
    ]})
    assert rows(jobs.duration_vs_league(t.events)) == [("Blues", 4.0, 3.0, 1.0), ("Reds", 2.0, 3.0, -1.0)]


def test_cross_rank(load):
    cross = lambda team, outcome=None: passed(outcome, cross=True, team=team)
    t = load({
        1: [cross("A"), cross("B"), cross("C", "Out"), cross("C"), passed(team="C"), passed(cross=False, team="C")],
        2: [cross("C")],
    }, [match(1, season=1), match(2, season=2)])
    assert rows(jobs.cross_rank(t.events, t.matches)) == [
        ("A", 1, 1.0, 1), ("B", 1, 1.0, 1), ("C", 1, 0.5, 3), ("C", 2, 1.0, 1),
    ]
    assert rows(jobs.cross_rank(t.events, t.matches, top=2), "team_name") == [("A",), ("B",), ("C",)]


def test_goals_growth(load):
    t = load(
        {1: [shot()] * 10, 2: [shot()] * 15, 3: [shot()]},
        [match(1, season=1), match(2, season=2), match(3, season=7, competition=2)],
        [competition("Cup", 1), competition("Cup", 2), competition("League", 7, key=2)],
    )
    assert rows(jobs.goals_growth(*t)) == [
        ("Cup", 1, 10, None, None), ("Cup", 2, 15, 10, 0.5), ("League", 7, 1, None, None),
    ]


def test_season_without_competition_row_drops_out(load):
    t = load({1: [shot()]}, [match(1, season=5)])
    assert rows(jobs.goals_growth(*t)) == []


def test_mean_of_differences_is_zero(spark):
    from touchline.operators import diff_from_mean

    df = spark.range(1, 200).select((F.col("id") * 0.37).alias("v"))
    assert diff_from_mean(df, "v").agg(F.avg("diff")).first()[0] == pytest.approx(0, abs=1e-9)


def test_no_season_is_dropped(spark, tmp_path):
    """Orders of 1850 and 2150 keep their goals and shots, in the competitions as in the reports."""
    given = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "lineitem", "part"):
        star.table(spark, given, name).write.parquet(f"{tmp_path}/{name}.parquet")
    moved = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1850-03-01")).when(F.col("o_orderkey") % 3 == 1, F.lit("2150-03-01"))
    star.table(spark, given, "orders").withColumn(
        "o_orderdate", F.coalesce(moved.cast("timestamp_ntz"), "o_orderdate")
    ).write.parquet(f"{tmp_path}/orders.parquet")
    places, held = star.matches(spark, tmp_path), star.competitions(spark, tmp_path)
    goals = star.events(spark, tmp_path, "Shot", only=star.RETURNED)
    shots = star.events(spark, tmp_path, "Shot", parts=True)
    by_year = rows(jobs.goals_growth(goals, places, held).groupBy("season_id").agg(F.sum("goals")), "season_id", "sum(goals)")
    assert sum(n for _, n in by_year) == goals.count() and {1850, 2150} <= {y for y, _ in by_year}
    assert jobs.conversion_by_position(shots, places, held).agg(F.sum("shots")).first()[0] == shots.count()

"""Live scores: enrichment, windows, late rows, and sinks that can be repeated."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from touchline import functions as flat, schemas
from touchline.sinks import start_append
from touchline.sources import read_stream, replay
from touchline.streaming import (
    attach_player, await_all, enrich, high_scoring, one_per_key, run_all, team_form, tumbling_avg,
)


def score(clock, home=1, away=0, team="Reds", match="m1", **more):
    return {
        "match_id": match, "home_team": team, "away_team": "Blues", "home_score": home, "away_score": away,
        "minute": 1, "timestamp": f"2024-01-01T{clock}:00Z", **more,
    }


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of text payloads; call it to add a file, read it as a stream."""
    folder = tmp_path / "feed"
    folder.mkdir()

    class Feed:
        files = 0

        def __call__(self, *records):
            lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
            (folder / f"{self.files}.txt").write_text("\n".join(lines))
            self.files += 1

        def stream(self, one_by_one=False):
            options = {"maxFilesPerTrigger": "1"} if one_by_one else {}
            return read_stream(spark, "text", str(folder), **options)

        def scores(self, **kw):
            return flat.parse_scores(self.stream(**kw))

        def batch(self):
            return flat.parse_scores(spark.read.text(str(folder)))

    return Feed()


@pytest.fixture
def drain(spark, tmp_path):
    """Run a stream over what is there and return all its output so far."""

    def run(df, name="out"):
        start_append(df, name, str(tmp_path / "state"), str(tmp_path / "sink"), available_now=True).awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/sink/{name}").drop("batch_id")

    return run


def clocks(df, *columns):
    return rows(df, F.date_format("window.start", "HH:mm"), *columns)


def test_enrich_keeps_unknown_teams_and_malformed_payloads(spark, feed, drain):
    feed(score("10:00"), score("10:01", team="Greys"), "{bad")
    teams = spark.createDataFrame([("Reds", "Chile", "The Park")], "team_name string, country string, stadium string")
    out = drain(enrich(feed.scores(), teams))
    assert rows(out, "home_team", "country", "stadium") == [
        (None, None, None), ("Greys", None, None), ("Reds", "Chile", "The Park"),
    ]


def test_duplicate_team_leaves_sums_alone(spark, feed, drain):
    feed(score("10:00", home=3), score("11:00"))
    teams = spark.createDataFrame([("Reds", "Peru"), ("Reds", "Chile"), ("Reds", None)], "team_name string, country string")
    assert rows(one_per_key(teams, "team_name")) == [("Reds", "Chile")]
    out = drain(team_form(enrich(feed.scores(), teams), size="5 minutes", slide="5 minutes"))
    assert clocks(out, "goals_scored", "goals_conceded") == [("10:00", 3, 0)]


def test_fullest_row_speaks_for_its_key(spark):
    teams = spark.createDataFrame(
        [("Reds", None, "Park", None), ("Reds", "Chile", "Park", {"a": 1}), ("Reds", "Zaire", "Park", {"a": 1}), ("Blues", None, None, None)],
        "team_name string, country string, stadium string, notes map<string, int>",
    )
    assert rows(one_per_key(teams, "team_name"), "team_name", "country", "stadium") == [
        ("Blues", None, None), ("Reds", "Chile", "Park"),
    ]


def test_one_per_key_without_other_columns(spark):
    assert rows(one_per_key(spark.createDataFrame([("a",), ("a",)], "k string"), "k")) == [("a",)]


def test_tumbling_average(feed, drain):
    feed(score("10:00", 1), score("10:09", 2), score("10:10", 5), score("10:05", 9, team="Blues"), "{bad", score("10:40"))
    out = drain(tumbling_avg(feed.scores()))
    assert clocks(out, "home_team", "avg_home_goals") == [("10:00", "Blues", 9.0), ("10:00", "Reds", 1.5), ("10:10", "Reds", 5.0)]


def test_alert_needs_more_than_the_threshold(feed, drain):
    feed(score("10:00", 2, 2), score("10:00", 3, 2, match="m2"), score("11:00", match="m3"))
    out = drain(high_scoring(feed.scores()))
    assert clocks(out, "match_id", "total_goals") == [(f"{9 + (m >= 60):02d}:{m % 60:02d}", "m2", 5) for m in range(56, 61)]


def test_team_form_slides_by_five_minutes(feed, drain):
    feed(score("10:00", 1, 2), score("10:20", 3, 1), score("12:00"))
    out = drain(team_form(feed.scores()))
    both = [("09:55", 4, 3), ("10:00", 4, 3)]
    got = clocks(out, "goals_scored", "goals_conceded")
    assert len(got) == 10 and [r for r in got if r[1] == 4] == both
    assert got[0] == ("09:35", 1, 2) and got[-1] == ("10:20", 3, 1)


def test_late_row_is_dropped_in_the_next_run(feed, drain):
    feed(score("00:05", 1), score("00:30", 2))
    drain(tumbling_avg(feed.scores()))
    feed(score("00:06", 100), score("00:50", 3))
    out = drain(tumbling_avg(feed.scores()))
    assert clocks(out, "avg_home_goals") == [("00:00", 1.0), ("00:30", 2.0)]


@pytest.mark.parametrize("windows", [tumbling_avg, high_scoring, team_form])
def test_stream_equals_batch_on_closed_windows(spark, feed, drain, windows):
    for part in range(3):
        feed(*[
            score(f"{10 + part}:{(7 * i) % 60:02d}", i % 4, (i * 3) % 5, team=f"T{i % 3}", match=f"m{i % 5}")
            for i in range(40)
        ])
    streamed = drain(windows(feed.scores()))
    last = feed.batch().agg(F.max("timestamp")).first()[0]
    closed = windows(feed.batch()).where(F.col("window.end") <= F.lit(last) - F.expr("INTERVAL 1 MINUTE"))
    columns = streamed.columns[1:]
    assert rows(streamed, "window.start", *columns) == rows(closed, "window.start", *columns) != []


def test_attach_player_to_goals(spark, tmp_path, drain):
    folder = str(tmp_path / "goals")
    spark.createDataFrame([("goal", 1), ("corner", 1), ("goal", 2)], "kind string, scorer long").write.json(folder)
    lineup = spark.createDataFrame([(1, "Ann", "Wing")], "player_id long, player_name string, position string")
    stream = read_stream(spark, "json", folder, spark.read.json(folder).schema)
    out = drain(attach_player(stream, lineup, on="scorer", goal=F.col("kind") == "goal"))
    assert rows(out, "scorer", "player_name", "position") == [(1, "Ann", "Wing"), (2, None, None)]


def test_repeated_batch_changes_nothing(spark, feed, tmp_path):
    """A batch that was written but not committed runs again after a restart, and overwrites itself."""
    feed(score("10:00"))

    def run():
        start_append(
            feed.scores(), "all", str(tmp_path / "state"), str(tmp_path / "sink"), available_now=True
        ).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/sink/all")

    assert run().count() == 1
    # Undo the commit: the state of a driver that died between the write and the commit.
    for commit in (tmp_path / "state" / "all" / "commits").iterdir():
        if commit.name in ("0", ".0.crc"):
            commit.unlink()
    feed(score("10:01"))
    out = run()
    assert rows(out, "batch_id", F.date_format("timestamp", "HH:mm")) == [(0, "10:00"), (1, "10:01")]


def test_all_three_collections_with_or_without_teams(spark, feed, tmp_path):
    feed(score("10:00", 4, 3), score("12:00"))
    teams = spark.createDataFrame([("Reds", "Chile"), ("Reds", "Peru")], "team_name string, country string")
    for name, static in (("with", teams), ("without", None)):
        run_all(
            feed.stream(), str(tmp_path / name / "state"), static, root=str(tmp_path / name), available_now=True
        )
    for name, count in (("avg_goals_per_10min", 1), ("high_scoring_alerts", 5), ("team_form_30min", 6)):
        first, second = (rows(spark.read.parquet(f"{tmp_path}/{w}/{name}").drop("window")) for w in ("with", "without"))
        assert first == second and len(first) == count
    assert spark.streams.active == []


def test_failure_of_one_query_stops_all(spark, feed, tmp_path):
    feed(score("10:00"))
    scores = feed.scores(one_by_one=True)
    good = start_append(scores, "good", str(tmp_path / "state"), str(tmp_path / "sink"))
    broken = scores.withColumn("home_team", F.raise_error(F.lit("broken on purpose")).cast("string"))
    bad = start_append(broken, "bad", str(tmp_path / "state"), str(tmp_path / "sink"))
    with pytest.raises(Exception, match="broken on purpose"):
        await_all([good, bad], poll=0.2)
    assert not good.isActive and not bad.isActive


def test_stream_to_a_connector(spark, feed, tmp_path):
    """Without a root, options place the output; here a JSON folder stands for the connector."""
    feed(score("10:00"), score("10:01"))
    start_append(
        feed.scores(), "live", str(tmp_path / "state"), fmt="json", available_now=True, path=str(tmp_path / "docs")
    ).awaitTermination()
    assert spark.read.schema(schemas.SCORES).json(str(tmp_path / "docs")).count() == 2


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_replayed_rows_leave_few_windows_open(spark, tmp_path, fmt):
    """Rows lie in no order; their files come in the order of time, so none is late and closed windows leave the state."""
    start = F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 4000 * 60)
    scores = spark.range(0, 4000, 1, 4).select(
        start.alias("timestamp"), (F.col("id") % 40).cast("string").alias("home_team"), (F.col("id") % 5).cast("int").alias("home_score"),
    ).withColumn("value", F.to_json(F.struct("home_team", "home_score", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))))
    replay(scores, "timestamp", str(tmp_path / "feed"), fmt, each=400)
    stream = read_stream(spark, fmt, str(tmp_path / "feed"), None if fmt == "text" else scores.schema, maxFilesPerTrigger="1")
    out = tumbling_avg(flat.parse_scores(stream) if fmt == "text" else stream)
    query = start_append(out, "out", str(tmp_path / "state"), str(tmp_path / "sink"), available_now=True)
    query.awaitTermination()
    last = scores.agg(F.max("timestamp")).first()[0]
    closed = tumbling_avg(scores).where(F.col("window.end") <= F.lit(last) - F.expr("INTERVAL 1 MINUTE"))
    found = rows(spark.read.schema(out.schema).parquet(f"{tmp_path}/sink/out"), *closed.columns)
    assert found == rows(closed) and len(found) > 3900
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) < 1300

"""The daily run over new raw files only."""

import shutil
from pathlib import Path

import pytest
from conftest import rows
from football import competition, dribble, event, match, named, passed, shot
from pyspark.sql import functions as F

from touchline.__main__ import main
from touchline.plans import daily, jobs, partials
from touchline.sinks import read_curated


@pytest.fixture
def raw(dump, tmp_path):
    dump("events/1.json", [passed(), shot(player="Bea"), {**event("Half Start"), "type": None}])
    dump("events/2.json", [passed("Out"), shot(player="Ann")])
    dump("matches/1/1.json", [match(n, f"2020-01-0{n}", season=1) for n in (1, 2, 3)])
    dump("competitions.json", [competition("Cup", 1)])
    return str(tmp_path)


def _events(spark, silver):
    return daily.tables_of(spark, silver, ["events"])["events"]


def test_a_second_run_reads_the_new_file_alone(spark, raw, dump):
    silver, state, curated = f"{raw}/silver", f"{raw}/state", f"{raw}/curated"
    first = daily.run_all(spark, raw, silver, curated, checkpoint=state)
    assert first["events"] == {"rows": 5, "rejects": 0, "without_key": 0}
    dump("events/3.json", [passed(), passed("Out"), shot(player="Cat")])
    assert daily.run_all(spark, raw, silver, curated, checkpoint=state)["events"]["rows"] == 3
    assert daily.run_all(spark, raw, silver, curated, checkpoint=state)["events"]["rows"] == 0

    daily.run_all(spark, raw, f"{raw}/whole", f"{raw}/whole_curated")
    whole, kept = _events(spark, f"{raw}/whole"), _events(spark, silver)
    assert kept.schema == whole.schema
    some = [f.name for f in whole.schema if f.dataType.typeName() != "variant"]
    assert kept.select(some).exceptAll(whole.select(some)).isEmpty() and kept.count() == whole.count() == 8
    for name in jobs.REPORTS:
        assert rows(read_curated(spark, name, curated)) == rows(read_curated(spark, name, f"{raw}/whole_curated")), name


def test_a_repeated_batch_changes_nothing(spark, raw):
    silver, state = f"{raw}/silver", f"{raw}/state"
    daily.ingest(spark, raw, silver, state, ["events"])
    before = rows(_events(spark, silver).groupBy("match_id", "event_type_name").count())
    # As after a failure between the write and its commit.
    (Path(state) / "events" / "commits" / "0").unlink()
    (Path(state) / "events" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert daily.ingest(spark, raw, silver, state, ["events"])["events"]["rows"] == 5
    assert rows(_events(spark, silver).groupBy("match_id", "event_type_name").count()) == before


def test_rejects_of_new_files_are_kept_and_the_next_run_goes_on(spark, raw, dump):
    silver, state = f"{raw}/silver", f"{raw}/state"
    Path(raw, "events/9.json").write_text('[{"id": "cut')
    with pytest.raises(daily.TooManyRejects, match="1 of 6 new records"):
        daily.ingest(spark, raw, silver, state, ["events"])
    assert _events(spark, silver).count() == 5
    bad = spark.read.parquet(f"{silver}/rejects/events")
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["9.json"]
    dump("events/3.json", [passed()])
    assert daily.ingest(spark, raw, silver, state, ["events"])["events"]["rows"] == 1
    assert spark.read.parquet(f"{silver}/rejects/events").count() == 1


def test_reports_still_read_one_kind_of_event(spark, raw):
    daily.ingest(spark, raw, f"{raw}/silver", f"{raw}/state", ["events"])
    plan = _events(spark, f"{raw}/silver").where(F.col("event_type_name") == "Shot")
    assert plan.count() == 2
    files = {f.rsplit("/", 2)[1] for f in plan.inputFiles()}
    assert "event_type_name=Shot" in files
    assert "PartitionFilters: [isnotnull(event_type_name" in plan._jdf.queryExecution().toString()


def test_command_line(spark, raw):
    for _ in range(2):
        main(["daily", "--raw", raw, "--silver", f"{raw}/s", "--out", f"{raw}/c", "--checkpoint", f"{raw}/state",
              "--report", "goals_yoy_growth"])
    assert _events(spark, f"{raw}/s").count() == 5


def test_reports_from_partials_equal_those_from_events(spark, raw, dump):
    silver, state = f"{raw}/silver", f"{raw}/state"
    dump("events/1.json", [
        passed(cross=True), passed("Out", cross=True), passed(), shot(player="Bea", xg=0.5, position=named("Wing")),
        shot("Saved", xg=None, position=named("Wing")), dribble(), dribble("Incomplete"),
        event("Pressure", counterpress=True, duration=2.0), event("Carry", team="Blues", duration=1.0),
    ])
    daily.ingest(spark, raw, silver, state, ["events"])
    dump("events/3.json", [passed(), shot(xg=0.25, position=named("Back")), event("Pressure", counterpress=True), event("Carry", duration=3.5)])
    daily.ingest(spark, raw, silver, state, ["events"])
    assert partials.missing(spark, silver) == []
    daily.transform(spark, raw, silver, ["competitions", "matches"])
    tables = jobs.Tables(**daily.tables_of(spark, silver, jobs.Tables._fields))
    kept = partials.stored(spark, silver)
    for name, report in partials.REPORTS.items():
        expected = jobs.REPORTS[name](tables)
        got = report(kept, tables)
        assert got.columns == expected.columns and [f.dataType for f in got.schema] == [f.dataType for f in expected.schema], name
        assert rows(got) == rows(expected), name
    assert set(jobs.REPORTS) - set(partials.REPORTS) == {"assist_combinations"}


def test_groups_in_several_batches_merge_and_a_repeated_batch_changes_nothing(spark, raw):
    daily.transform(spark, raw, f"{raw}/whole", ["competitions", "matches", "events"])
    tables = jobs.Tables(**daily.tables_of(spark, f"{raw}/whole", jobs.Tables._fields))
    odd = F.xxhash64("event_id") % 2 == 0
    for batch, some in ((0, odd), (1, ~odd), (1, ~odd), (0, odd)):
        partials.store(tables.events.where(some), f"{raw}/parts", batch)
    kept = partials.stored(spark, f"{raw}/parts")
    for name, report in partials.REPORTS.items():
        assert rows(report(kept, tables)) == rows(jobs.REPORTS[name](tables)), name


def test_batches_from_before_partials_are_folded(spark, raw, dump):
    silver, state = f"{raw}/silver", f"{raw}/state"
    daily.ingest(spark, raw, silver, state, ["events"])
    shutil.rmtree(f"{silver}/partials")
    dump("events/3.json", [shot(player="Cat")])
    assert partials.missing(spark, silver) == [0]
    daily.ingest(spark, raw, silver, state, ["events"])
    assert partials.missing(spark, silver) == []
    assert rows(partials.top_scorers(partials.stored(spark, silver)), "player_name", "goals") == [("Ann", 1), ("Bea", 1), ("Cat", 1)]

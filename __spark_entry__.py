"""

The reports run on the driver's tables in the roles of ``touchline.sources.star``. Times and dates
leave as text and doubles rounded to six digits, so that the comparison does not hang on a client's
types or on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline import functions as flat
from touchline.operators import diff_from_mean, lagged, mean_by, ranked, running, sum_through
from touchline.plans import jobs, partials
from touchline.schemas import OPAQUE
from touchline.session import scratch
from touchline.sinks import (
    read_curated, read_transformed, start_append, write_curated, write_transformed,
)
from touchline.sources import (
    read_competitions, read_events, read_lineups, read_matches, read_stream, read_teams, register_views,
    replay, star,
)
from touchline.streaming import attach_player, enrich, high_scoring, run_all, team_form, tumbling_avg

# The training-data queries are there when their subpackage and the pipeline are.
try:
    from touchline.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("touchline.llm", "corpus_pipeline"):
        raise
    _llm = None

_DIGITS = 6


def _plain(df: DataFrame, *doubles: str) -> DataFrame:
    """Rounded doubles, dates as text."""
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns(
        {c: F.round(c, _DIGITS) for c in doubles} | {c: F.col(c).cast("string") for c in dates}
    )


def _utc(spark: SparkSession) -> SparkSession:
    """The tables hold wall-clock times; read as instants they need a zone without gaps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# --- the ten reports ---------------------------------------------------------------------------


def _top_scorers(spark, d):
    return jobs.top_scorers(star.clicks(spark, d, "purchase"))


def _pass_completion(spark, d, n=5):
    passes = star.events(spark, d, "Pass", only=star.OPEN)
    out = jobs.pass_completion(passes, star.matches(spark, d, placed=False), n=n)
    return _plain(out, "completion_rate", "running_avg_completion")


def _xg_rank(spark, d, top=None):
    shots = star.events(spark, d, "Shot", parts=True)
    return jobs.xg_rank(shots, star.matches(spark, d), star.competitions(spark, d), top=top)


def _dribbles(spark, d):
    dribbles = star.events(spark, d, "Dribble", only=star.RETURNED)
    return jobs.dribbles_vs_previous(dribbles, star.matches(spark, d, placed=False), player="team_name")


def _assists(spark, d, **kw):
    events = star.clicks(spark, d, "click", "purchase")
    return _plain(jobs.assist_pairs(events, star.click_days(spark, d), **kw))


def _conversion(spark, d, **kw):
    shots = star.events(spark, d, "Shot", parts=True)
    out = jobs.conversion_by_position(shots, star.matches(spark, d), star.competitions(spark, d), **kw)
    return _plain(out, "conversion_rate", "percentile_rank")


def _counterpress(spark, d):
    out = jobs.counterpress(star.events(spark, d, "Pressure"), star.matches(spark, d, placed=False))
    return _plain(out, "rolling_avg_counterpress")


def _duration(spark, d):
    out = jobs.duration_vs_league(star.events(spark, d, "Carry"))
    return _plain(out, "team_avg_duration", "league_avg_duration", "diff_from_league_avg")


def _cross_rank(spark, d, top=None):
    crosses = star.events(spark, d, "Pass", only=star.OPEN)
    out = jobs.cross_rank(crosses, star.matches(spark, d, placed=False), top=top, fold=False)
    return _plain(out, "cross_completion")


def _goals_growth(spark, d):
    goals = star.events(spark, d, "Shot", only=star.RETURNED)
    out = jobs.goals_growth(goals, star.matches(spark, d), star.competitions(spark, d))
    return _plain(out, "yoy_growth")


# --- streams -----------------------------------------------------------------------------------


def _drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there now, through the streaming sink, and read back the result."""
    root = scratch(spark, name)
    start_append(stream, name, f"{root}/checkpoint", root, available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/{name}").drop("batch_id")


def _windows(df: DataFrame, *doubles: str) -> DataFrame:
    bounds = [F.date_format(f"window.{end}", "yyyy-MM-dd HH:mm:ss").alias(f"window_{end}") for end in ("start", "end")]
    return _plain(df.select(*bounds, *[c for c in df.columns if c != "window"]), *doubles)


def _customers(spark, d):
    return star.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def _enrich(spark, d):
    scores = star.live(_utc(spark), d).select("event_id", "user_id", "event_type", "value")
    return _drain(spark, enrich(scores, _customers(spark, d), "user_id", "c_custkey"), "l1_enrich")


def _tumbling(spark, d):
    out = tumbling_avg(star.live(_utc(spark), d, timed=True), "user_id", "value", "avg_value")
    return _windows(_drain(spark, out, "l2_tumbling"), "avg_value")


def _alerts(spark, d):
    out = high_scoring(star.live(_utc(spark), d, timed=True), "user_id", "value", "k", threshold=60)
    return _windows(_drain(spark, out, "l3_alerts"), "total_goals")


def _form(spark, d):
    out = team_form(star.live(_utc(spark), d, timed=True), "user_id", "value", "k")
    return _windows(_drain(spark, out, "l4_form"), "goals_scored")


def _attach(spark, d):
    scores = star.live(_utc(spark), d).select("event_id", "user_id", "event_type", "value")
    out = attach_player(
        scores, _customers(spark, d), "user_id", "c_custkey", goal=F.col("event_type") == "purchase"
    )
    return _drain(spark, out, "l5_attach")


# --- nested data, sources and sinks ------------------------------------------------------------


def _named(key: str, name: str | None = None):
    return F.struct(F.col(key).alias("id"), (F.col(name) if name else F.lit(None).cast("string")).alias("name"))


def _pair(number: int, word: str):
    """A struct of id and name that no other field has."""
    return F.struct(
        (F.col("o_orderkey") + number).alias("id"), F.concat(F.lit(word), F.col("o_orderkey").cast("string")).alias("name")
    )


def _nested_orders(spark, d) -> DataFrame:
    """Orders as raw match records, with a value of its own in every field."""
    key = F.col("o_orderkey")
    return star.table(spark, d, "orders").select(
        key.alias("match_id"),
        F.to_date("o_orderdate").cast("string").alias("match_date"),
        F.concat(F.lit("kick"), key.cast("string")).alias("kick_off"),
        (key + 1).alias("home_score"),
        (key + 2).alias("away_score"),
        F.month("o_orderdate").cast("long").alias("match_week"),
        _pair(3, "stage").alias("competition_stage"),
        F.struct(F.col("o_custkey").alias("id")).alias("competition"),
        F.struct(F.year("o_orderdate").cast("long").alias("id")).alias("season"),
        _pair(4, "home").alias("home_team"),
        _pair(5, "away").alias("away_team"),
        _pair(6, "stadium").alias("stadium"),
        _pair(7, "referee").alias("referee"),
        F.struct(F.col("o_orderstatus").alias("data_version")).alias("metadata"),
    )


def _flatten_matches(spark, d):
    return _plain(flat.matches(_nested_orders(spark, d)))


def _json_matches(spark, d):
    """Match records written as JSON two folders deep and read back."""
    root = scratch(spark, "json-matches")
    nested = _nested_orders(spark, d)
    nested.withColumn("folder", F.col("season.id")).write.partitionBy("folder").json(f"{root}/matches")
    read = read_matches(spark, f"{root}/matches/*/*.json", multiline=False, mode="FAILFAST")
    return _plain(flat.matches(read))


def _customers_as_competitions(spark, d) -> DataFrame:
    """Customers as competition records, with a field too many."""
    return star.table(spark, d, "customer").select(
        F.col("c_custkey").alias("competition_id"),
        F.col("c_nationkey").cast("long").alias("season_id"),
        F.col("c_name").alias("competition_name"),
        F.col("c_mktsegment").alias("competition_gender"),
        F.concat(F.lit("land"), F.col("c_custkey").cast("string")).alias("country_name"),
        F.col("c_nationkey").cast("string").alias("season_name"),
        F.col("c_acctbal").alias("balance"),
    )


def _flatten_competitions(spark, d):
    return flat.competitions(_customers_as_competitions(spark, d))


def _pretty(df: DataFrame, key: str, root: str, each: int = 500) -> None:
    """Records as pretty-printed arrays, of ``each`` keys a file."""
    record = F.struct(*[c for c in df.columns if c != "number"])
    arrays = df.groupBy(F.expr(f"{key} div {each}").alias("folder")).agg(F.collect_list(record).alias("all"))
    text = arrays.select("folder", F.to_json("all", {"pretty": "true"}).alias("value"))
    text.write.partitionBy("folder").text(root)


def _pretty_competitions(spark, d):
    root = scratch(spark, "pretty-competitions")
    _pretty(_customers_as_competitions(spark, d), "competition_id", f"{root}/competitions")
    return flat.competitions(read_competitions(spark, f"{root}/competitions/*/*", mode="FAILFAST"))


def _squads(spark, d) -> DataFrame:
    """Orders as teams. Fulfilled ones list two players, open ones an empty lineup, others none."""
    player = F.struct(
        F.col("o_custkey").alias("player_id"),
        F.concat(F.lit("player"), F.col("o_custkey").cast("string")).alias("player_name"),
        F.concat(F.lit("nick"), F.col("o_custkey").cast("string")).alias("player_nickname"),
        (F.col("o_orderkey") + 1).alias("jersey_number"),
        _pair(2, "country").alias("country"),
    )
    players = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 0)
    return star.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("team_id"),
        F.col("o_orderpriority").alias("team_name"),
        F.array_repeat(player, players).alias("lineup"),
    )


def _explode_lineups(spark, d, outer=False):
    return flat.lineups(_squads(spark, d), outer)


def _json_lineups(spark, d):
    root = scratch(spark, "json-lineups")
    _squads(spark, d).write.json(f"{root}/lineups")
    return flat.lineups(read_lineups(spark, f"{root}/lineups/*.json", multiline=False, mode="FAILFAST"))


_NUMBERS = ["index", "period", "minute", "second", "possession"]
_NAMED = ["type", "possession_team", "play_pattern", "team", "player", "position"]
_FLAGS = ["under_pressure", "off_camera", "out", "counterpress"]


def _raw_events(spark, d) -> DataFrame:
    """Web events as raw event records, with a value of its own in every field."""
    key = F.col("event_id")
    word = key.cast("string")
    fields = {
        "match_id": F.unix_date(F.to_date("ts")).cast("long"),
        "id": word,
        "timestamp": F.date_format("ts", "HH:mm:ss"),
        "location": F.array(key + 0.25, key + 0.75),
        "duration": F.col("value"),
        "related_events": F.array(F.concat(F.lit("r"), word), F.lit("last")),
        **{name: key + 10 + i for i, name in enumerate(_NUMBERS)},
        **{name: F.struct((key + 20 + i).alias("id"), F.concat(F.lit(name), word).alias("name"))
           for i, name in enumerate(_NAMED) if name != "type"},
        "type": F.struct((key + 20).alias("id"), F.col("event_type").alias("name")),
        **{name: F.when(key % (i + 2) == 0, key % 5 == 0) for i, name in enumerate(_FLAGS)},
        **{name: F.struct((key + 40 + i).alias("k")) for i, name in enumerate(OPAQUE)},
    }
    outcome = F.struct(F.concat(F.lit("out"), word).alias("name"))
    click, rest = F.col("event_type") == "click", F.col("event_type") != "click"
    fields["pass"] = F.when(click, F.struct(
        outcome.alias("outcome"), F.get_json_object("props", "$.k").alias("assisted_shot_id"),
        (key % 3 == 0).alias("goal_assist"), (key % 4 == 0).alias("cross"), (key + 0.5).alias("length"),
        F.struct((key + 60).alias("id")).alias("recipient"),
    ))
    fields["shot"] = F.when(rest, F.struct(
        (key / 8).alias("statsbomb_xg"), outcome.alias("outcome"), F.concat(F.lit("foot"), word).alias("body_part"),
    ))
    fields["dribble"] = F.when(rest, F.struct(outcome.alias("outcome"), (key % 2 == 0).alias("nutmeg")))
    return star.table(_utc(spark), d, "events").select(
        *[c.alias(name) for name, c in fields.items()], key.alias("number")
    )


def _flat_events(read: DataFrame) -> DataFrame:
    """Every column of the flat table in a form that compares, and fields that no report reads."""
    out = flat.events(read)
    inside = {
        "assisted_shot_id": "pass.assisted_shot_id", "goal_assist": "pass.goal_assist", "crossed": "pass.cross",
        "pass_outcome": "pass.outcome.name", "xg": "shot.statsbomb_xg", "shot_outcome": "shot.outcome.name",
        "dribble_outcome": "dribble.outcome.name",
    }
    whole = {
        "pass_length": ("pass_whole", "$.length", "double"), "recipient": ("pass_whole", "$.recipient.id", "long"),
        "body_part": ("shot_whole", "$.body_part", "string"), "nutmeg": ("dribble_whole", "$.nutmeg", "boolean"),
        **{name: (name, "$.k", "long") for name in OPAQUE},
    }
    picked = {name: F.col(path) for name, path in inside.items()}
    picked |= {name: F.try_variant_get(column, path, kind) for name, (column, path, kind) in whole.items()}
    picked |= {"location": F.array_join(F.col("location").cast("array<string>"), " "),
               "related_events": F.array_join("related_events", " "), "duration": F.round("duration", _DIGITS)}
    plain = [c for c, kind in out.dtypes if c not in picked and kind != "variant" and not kind.startswith("struct")]
    return out.select(*plain, *[c.alias(name) for name, c in picked.items()])


def _json_events(spark, d):
    """Event records as JSON lines, read back and flattened."""
    root = scratch(spark, "json-events")
    _raw_events(spark, d).drop("number").write.json(f"{root}/events")
    return _flat_events(read_events(spark, f"{root}/events/*.json", multiline=False, mode="FAILFAST"))


def _pretty_events(spark, d):
    root = scratch(spark, "pretty-events")
    _pretty(_raw_events(spark, d), "number", f"{root}/events")
    return _flat_events(read_events(spark, f"{root}/events/*/*", mode="FAILFAST"))


def _connector(spark, d):
    """A result replaced through a connector that takes its place and name as options."""
    root = scratch(spark, "connector")
    for _ in range(2):
        write_curated(_dribbles(spark, d), "dribbles_with_lag", fmt="json", path=root)
    schema = "team_name long, season_id long, dribbles long, prev_season_dribbles long"
    return spark.read.schema(schema).json(root)


def _late_rows(spark, d):
    """Events of odd ids come in a second run; those of windows closed by then count for nothing."""
    root = scratch(_utc(spark), "late-rows")
    for odd in (0, 1):
        star.table(spark, d, "events").where(F.col("event_id") % 2 == odd).write.mode("append").parquet(f"{root}/in")
        stream = read_stream(spark, "parquet", f"{root}/in", star.COLUMNS["events"])
        out = tumbling_avg(stream.withColumn("timestamp", F.col("ts").cast("timestamp")), "user_id", "value", "avg_value")
        start_append(out, "late", f"{root}/state", root, available_now=True).awaitTermination()
    found = spark.read.schema(out.schema).parquet(f"{root}/late").drop("batch_id")
    return _windows(found, "avg_value")


def _mean_so_far(spark, d, kind):
    """Running means of decimals, and of longs far beyond what their sum could hold."""
    if kind == "decimal":
        rows = star.table(spark, d, "orders").select(
            "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("v"))
        out = running(rows, ["o_orderstatus"], ["o_orderkey"], "v", "avg", None, "mean")
        return out.select("o_orderkey", "o_orderstatus", (F.col("mean") * 1_000_000).cast("long").alias("millionths"))
    rows = star.table(spark, d, "events").select("event_id", "event_type", (F.col("event_id") * 10**12).alias("v"))
    out = running(rows, ["event_type"], ["event_id"], "v", "avg", None, "mean")
    return out.select("event_id", "event_type", F.round(F.col("mean") / 10**12, _DIGITS).alias("mean"))


def _payloads(spark, d) -> DataFrame:
    """Web events as the JSON text of scores, a value of its own in every field."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    user = F.col("user_id").cast("string")
    return star.table(_utc(spark), d, "events").select("event_id", "ts", F.to_json(F.struct(
        user.alias("match_id"), F.concat(F.lit("home"), user).alias("home_team"),
        F.concat(F.lit("away"), user).alias("away_team"), k.alias("home_score"), (k % 7).alias("away_score"),
        F.minute("ts").alias("minute"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
    )).alias("value"))


def _parse_scores(spark, d):
    """Score payloads; every seventh is cut short and parses to NULLs."""
    text = F.when(F.col("event_id") % 7 == 0, F.expr("left(value, 3)")).otherwise(F.col("value"))
    parsed = flat.parse_scores(_payloads(spark, d).select(text.cast("binary").alias("value")))
    return parsed.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


def _live_job(spark, d):
    """The three collections of the live job over score payloads, side by side; these come in the order of time."""
    root = scratch(spark, "live-job")
    replay(_payloads(spark, d), "ts", f"{root}/feed", "text")
    feed = read_stream(spark, "text", f"{root}/feed", maxFilesPerTrigger="1")
    run_all(feed, f"{root}/state", root=f"{root}/out", available_now=True)
    columns = {
        "avg_goals_per_10min": ("home_team", "avg_home_goals", F.lit(None)),
        "high_scoring_alerts": ("match_id", "total_goals", F.lit(None)),
        "team_form_30min": ("home_team", "goals_scored", F.col("goals_conceded")),
    }
    found = [
        spark.read.parquet(f"{root}/out/{name}").select(
            F.lit(name).alias("collection"), F.col(who).alias("who"), "window",
            F.col(first).cast("double").alias("first"), second.cast("double").alias("second"),
        )
        for name, (who, first, second) in columns.items()
    ]
    return _windows(found[0].unionByName(found[1]).unionByName(found[2]), "first", "second")


def _adhoc_sql(spark, d):
    register_views(events=star.events(spark, d, "Pass", only=star.OPEN), matches=star.matches(spark, d))
    return spark.sql("""
        SELECT m.season_id, m.competition_id, count(*) AS passes,
               count_if(e.pass.outcome.name IS NULL) AS completed
        FROM events AS e JOIN matches AS m USING (match_id)
        WHERE e.event_type_name = 'Pass'
        GROUP BY ALL
    """)


def _transformed(spark, d):
    """Events laid out by kind, then read for one kind only."""
    root = scratch(spark, "transformed")
    write_transformed(star.clicks(spark, d), root, "events")
    goals = read_transformed(spark, root, "events").where(F.col("event_type_name") == "Shot")
    return goals.groupBy("player_name").agg(F.count(F.lit(1)).alias("goals"), F.max("event_id").alias("last_event"))


def _kept(spark, d, kind):
    """Partials of the line items of two days; the second day's batch is repeated, as after a failure."""
    root = scratch(spark, "partials")
    early = "coalesce(l_shipdate < DATE '1995-06-17', false)"
    for batch, days in ((0, early), (1, f"NOT {early}"), (1, f"NOT {early}")):
        partials.store(star.events(spark, d, kind, only=days), root, batch, ["match_id", "team_name"])
    return partials.stored(spark, root)


def _kept_completion(spark, d):
    out = partials.pass_completion(_kept(spark, d, "Pass"), star.matches(spark, d, placed=False))
    return _plain(out, "completion_rate", "running_avg_completion")


def _kept_counterpress(spark, d):
    out = partials.counterpress(_kept(spark, d, "Pressure"), star.matches(spark, d, placed=False))
    return _plain(out, "rolling_avg_counterpress")


def _kept_growth(spark, d):
    out = partials.goals_growth(_kept(spark, d, "Shot"), star.matches(spark, d), star.competitions(spark, d))
    return _plain(out, "yoy_growth")


def _curated(spark, d):
    root = scratch(spark, "curated")
    for _ in range(2):
        write_curated(_dribbles(spark, d), "dribbles_with_lag", root)
    return read_curated(spark, "dribbles_with_lag", root)


def _teams(spark, d):
    """A static dimension written as Parquet, read by its path."""
    root = scratch(spark, "teams")
    star.table(spark, d, "supplier").select(
        F.col("s_name").alias("team_name"), F.col("s_nationkey").cast("string").alias("country")
    ).write.parquet(root)
    return read_teams(spark, root)


# --- operators on their own --------------------------------------------------------------------


def _mean_diff(spark, d):
    means = mean_by(star.table(spark, d, "orders"), ["o_custkey"], "o_totalprice", "mean_price")
    out = diff_from_mean(means, "mean_price", "overall", "diff")
    return out.select("o_custkey", *[F.round(c, _DIGITS).alias(c) for c in ("mean_price", "overall", "diff")])


def _running_sum(spark, d):
    out = running(star.table(spark, d, "events"), ["event_type"], ["ts", "event_id"], "value", "sum", None, "so_far")
    return _plain(out.select("event_id", "event_type", "so_far"), "so_far")


def _running_count(spark, d):
    out = running(star.table(spark, d, "events"), ["event_type"], ["ts", "event_id"], None, "count", 100, "last_100")
    return out.select("event_id", "event_type", "last_100")


def _rank_events(spark, d, kind):
    out = ranked(star.table(spark, d, "events"), ["event_type"], "value", ["event_id"], kind, name="place")
    out = out.select("event_id", "event_type", "place")
    return _plain(out, "place") if kind == "percent" else out


def _lagged_days(spark, d):
    days = star.clicks(spark, d).groupBy("event_type_name", "match_id").agg(F.count(F.lit(1)).alias("n"))
    return lagged(days, ["event_type_name"], ["match_id"], "n", "n_before").withColumn(
        "match_id", F.col("match_id").cast("long")
    )


def _sides(spark, d) -> DataFrame:
    """Line items as events of ten sides, each in a possession of one of them."""
    return star.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("index"),
        (F.col("l_suppkey") % 10).alias("team_name"), (F.col("l_partkey") % 10).alias("possession_team_name"),
        (F.col("l_linenumber") % 2).alias("possession"), F.col("l_quantity").alias("duration"),
        (F.col("l_linestatus") == "F").alias("counterpress"),
    )


def _possession(spark, d):
    out = jobs.possession_vs_league(_sides(spark, d))
    return _plain(out, "team_avg_duration", "league_avg_duration", "diff_from_league_avg")


def _turnovers(spark, d):
    out = jobs.counterpress_turnovers(_sides(spark, d), star.matches(spark, d, placed=False))
    return _plain(out, "rolling_avg_turnovers")


def _sums_by_segment(spark, d):
    orders = star.table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    out = sum_through(
        orders, star.table(spark, d, "customer"), "c_custkey", ["o_orderstatus"], ["c_mktsegment"],
        orders=F.lit(1), price=F.col("o_totalprice"),
    )
    return out.withColumn("price", F.round("price", 2))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "b0_top_scorers": _top_scorers,
    "b1_completion_running_avg": _pass_completion,
    "b2_avg_rank": _xg_rank,
    "b3_lag": _dribbles,
    "b4_linked_pairs": _assists,
    "b5_percentile": _conversion,
    "b6_rolling_count": _counterpress,
    "b7_diff_from_mean": _duration,
    "b8_rate_rank": _cross_rank,
    "b9_growth": _goals_growth,
    "l1_enrich": _enrich,
    "l2_tumbling": _tumbling,
    "l3_alerts": _alerts,
    "l4_form": _form,
    "l5_attach": _attach,
    "p1_flatten_competitions": _flatten_competitions,
    "p2_flatten": _flatten_matches,
    "p3_explode": _explode_lineups,
    "p3_explode_outer": lambda s, d: _explode_lineups(s, d, outer=True),
    "p4_flatten_events": _json_events,
    "p6_parse": _parse_scores,
    "s1_json_events_multiline": _pretty_events,
    "s3_json_matches": _json_matches,
    "s4_json_competitions": _pretty_competitions,
    "s5_json_lineups": _json_lineups,
    "s6_teams": _teams,
    "s10_adhoc_sql": _adhoc_sql,
    "k1_curated": _curated,
    "k2_connector": _connector,
    "k4_transformed": _transformed,
    "k5_incremental": _kept_completion,
    "k5_incremental_counterpress": _kept_counterpress,
    "k5_incremental_growth": _kept_growth,
    "a8_diff_from_overall_mean": _mean_diff,
    "a2_sums_by_segment": _sums_by_segment,
    "t5_late_rows": _late_rows,
    "t7_live_job": _live_job,
    "w2_avg_decimal": lambda s, d: _mean_so_far(s, d, "decimal"),
    "w2_avg_long": lambda s, d: _mean_so_far(s, d, "long"),
    "w3_dense_rank": lambda s, d: _rank_events(s, d, "dense"),
    "w4_lag": _lagged_days,
    "w5_count_last_100": _running_count,
    "w6_percent_rank": lambda s, d: _rank_events(s, d, "percent"),
    "w7_rank": lambda s, d: _rank_events(s, d, "rank"),
    "v_running_from_start": lambda s, d: _pass_completion(s, d, n=None),
    "v_running_sum_from_start": _running_sum,
    "v_sum_last_11": lambda s, d: _assists(s, d, fn="sum", n=11),
    "v_counterpress_turnover": _turnovers,
    "v_possession_duration": _possession,
    "v_percentile_ascending": lambda s, d: _conversion(s, d, ascending=True),
    "v_top3_dense": lambda s, d: _xg_rank(s, d, top=3),
    "v_top5_rank": lambda s, d: _cross_rank(s, d, top=5),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | (_llm.queries() if _llm else {})


def entry(spark: SparkSession) -> DataFrame:
    return _top_scorers(spark, "/root/testdata/sf0.001")


# --- the same in SQL ---------------------------------------------------------------------------

_MATCHES = """
    SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date,
           CAST(year(o_orderdate) AS BIGINT) AS season_id, r_name AS competition_name
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
_MATCH_SQL = """
    SELECT o_orderkey AS match_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS match_date,
           'kick' || o_orderkey AS kick_off, o_orderkey + 1 AS home_score, o_orderkey + 2 AS away_score,
           CAST(month(o_orderdate) AS BIGINT) AS match_week,
           o_orderkey + 3 AS competition_stage_id, 'stage' || o_orderkey AS competition_stage_name,
           o_custkey AS competition_id, CAST(year(o_orderdate) AS BIGINT) AS season_id,
           o_orderkey + 4 AS home_team_id, 'home' || o_orderkey AS home_team_name,
           o_orderkey + 5 AS away_team_id, 'away' || o_orderkey AS away_team_name,
           o_orderkey + 6 AS stadium_id, 'stadium' || o_orderkey AS stadium_name,
           o_orderkey + 7 AS referee_id, 'referee' || o_orderkey AS referee_name,
           o_orderstatus AS data_version
    FROM orders
"""
_PLAYERS = """
    SELECT o_orderkey AS team_id, o_orderpriority AS team_name, o_custkey AS player_id,
           'player' || o_custkey AS player_name, 'nick' || o_custkey AS player_nickname,
           o_orderkey + 1 AS jersey_number, o_orderkey + 2 AS country_id, 'country' || o_orderkey AS country_name
    FROM orders, (VALUES (1), (2)) AS twice (copy)
    WHERE o_orderstatus = 'F'
"""
_COMPETITION_SQL = """
    SELECT c_custkey AS competition_id, CAST(c_nationkey AS BIGINT) AS season_id, c_name AS competition_name,
           c_mktsegment AS competition_gender, 'land' || c_custkey AS country_name,
           CAST(c_nationkey AS VARCHAR) AS season_name
    FROM customer
"""
_EVENT_SQL = f"""
    SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS match_id,
           CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%H:%M:%S') AS timestamp,
           CAST(event_id + 0.25 AS DOUBLE) || ' ' || CAST(event_id + 0.75 AS DOUBLE) AS location,
           round(value, 6) AS duration, 'r' || event_id || ' last' AS related_events,
           {', '.join(f'event_id + {10 + i} AS "{name}"' for i, name in enumerate(_NUMBERS))},
           {', '.join(f"event_id + {20 + i} AS {name}_id, '{name}' || event_id AS {name}_name"
                      for i, name in enumerate(_NAMED) if name != "type")},
           event_id + 20 AS event_type_id, event_type AS event_type_name,
           {', '.join(f'CASE WHEN event_id % {i + 2} = 0 THEN event_id % 5 = 0 END AS "{name}"'
                      for i, name in enumerate(_FLAGS))},
           {', '.join(f'event_id + {40 + i} AS "{name}"' for i, name in enumerate(OPAQUE))},
           CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS assisted_shot_id,
           CASE WHEN event_type = 'click' THEN event_id % 3 = 0 END AS goal_assist,
           CASE WHEN event_type = 'click' THEN event_id % 4 = 0 END AS crossed,
           CASE WHEN event_type = 'click' THEN CAST(event_id + 0.5 AS DOUBLE) END AS pass_length,
           CASE WHEN event_type = 'click' THEN event_id + 60 END AS recipient,
           CASE WHEN event_type = 'click' THEN 'out' || event_id END AS pass_outcome,
           CASE WHEN event_type <> 'click' THEN event_id / 8 END AS xg,
           CASE WHEN event_type <> 'click' THEN 'foot' || event_id END AS body_part,
           CASE WHEN event_type <> 'click' THEN 'out' || event_id END AS shot_outcome,
           CASE WHEN event_type <> 'click' THEN 'out' || event_id END AS dribble_outcome,
           CASE WHEN event_type <> 'click' THEN event_id % 2 = 0 END AS nutmeg
    FROM events
"""


def _completion_sql(frame: str) -> str:
    return f"""
    WITH m AS ({_MATCHES}), rates AS (
        SELECT l_orderkey AS match_id, l_suppkey AS team_name,
               count(*) FILTER (WHERE l_returnflag = 'N') / count(*) AS rate
        FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)
    SELECT team_name, CAST(match_date AS VARCHAR) AS match_date, round(rate, 6) AS completion_rate,
           round(avg(rate) OVER (PARTITION BY team_name ORDER BY match_date, match_id {frame}), 6)
               AS running_avg_completion
    FROM rates JOIN m USING (match_id)
    """


_PRESSING_SQL = f"""
    WITH m AS ({_MATCHES}), counts AS (
        SELECT l_orderkey AS match_id, l_suppkey AS team_name, count(*) AS n
        FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
    SELECT team_name, CAST(match_date AS VARCHAR) AS match_date, n AS counterpress_events,
           round(avg(n) OVER (PARTITION BY team_name ORDER BY match_date, match_id
               ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_counterpress
    FROM counts JOIN m USING (match_id)
"""

_GROWTH_SQL = f"""
    WITH m AS ({_MATCHES}), counts AS (
        SELECT competition_name, season_id, count(*) AS goals
        FROM lineitem JOIN m ON l_orderkey = match_id WHERE l_returnflag = 'R' GROUP BY ALL),
    both_seasons AS (
        SELECT *, lag(goals) OVER (PARTITION BY competition_name ORDER BY season_id) AS prev_season_goals
        FROM counts)
    SELECT *, round((goals - prev_season_goals) / prev_season_goals, 6) AS yoy_growth
    FROM both_seasons
"""

_XG_SQL = f"""
    WITH m AS ({_MATCHES}), means AS (
        SELECT p_brand AS player_name, competition_name, round(avg(l_discount), 12) AS avg_xg
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN m ON l_orderkey = match_id GROUP BY ALL),
    places AS (
        SELECT *, dense_rank() OVER (PARTITION BY competition_name ORDER BY avg_xg DESC) AS rank_in_comp
        FROM means)
    SELECT * FROM places
"""
_CROSS_SQL = f"""
    WITH m AS ({_MATCHES}), rates AS (
        SELECT l_suppkey AS team_name, season_id,
               count(*) FILTER (WHERE l_returnflag = 'N') / count(*) AS rate
        FROM lineitem JOIN m ON l_orderkey = match_id WHERE l_linestatus = 'O' GROUP BY ALL),
    places AS (
        SELECT team_name, season_id, round(rate, 6) AS cross_completion,
               rank() OVER (PARTITION BY season_id ORDER BY rate DESC) AS rank_in_season
        FROM rates)
    SELECT * FROM places
"""


def _conversion_sql(sense: str) -> str:
    return f"""
    WITH m AS ({_MATCHES}), counts AS (
        SELECT competition_name AS league, p_type AS position_name, count(*) AS shots,
               count(*) FILTER (WHERE l_returnflag = 'R') AS goals
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN m ON l_orderkey = match_id GROUP BY ALL)
    SELECT league, position_name, shots, goals, round(goals / shots, 6) AS conversion_rate,
           round(percent_rank() OVER (PARTITION BY league ORDER BY goals / shots {sense}), 6)
               AS percentile_rank
    FROM counts
    """


def _assist_sql(last: str, before: int) -> str:
    return f"""
    WITH assists AS (
        SELECT c.user_id AS passer, p.user_id AS scorer, CAST(c.ts AS DATE) AS day, c.event_id
        FROM events c JOIN events p ON CAST(json_extract_string(c.props, '$.k') AS BIGINT) = p.event_id
        WHERE c.event_type = 'click' AND p.event_type = 'purchase')
    SELECT passer, scorer, CAST(day AS VARCHAR) AS match_date,
           CAST({last} OVER (PARTITION BY passer, scorer ORDER BY day, event_id
               ROWS BETWEEN {before} PRECEDING AND CURRENT ROW) AS BIGINT) AS assists_last_10
    FROM assists
    """


def _window_sql(minutes: int, slide: int, columns: str, having: str = "") -> str:
    """Windows of the web events that are closed at the end: a minute behind the last event."""
    return f"""
    WITH placed AS (
        SELECT e.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               time_bucket(INTERVAL '{slide} minutes', ts) - i * INTERVAL '{slide} minutes' AS start
        FROM events e, range({minutes // slide}) AS shift (i)),
    closed AS (
        SELECT start, user_id, {columns} FROM placed
        WHERE start + INTERVAL '{minutes} minutes' <= (SELECT max(ts) FROM events) - INTERVAL '1 minute'
        GROUP BY start, user_id {having})
    SELECT * EXCLUDE (start), strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(start + INTERVAL '{minutes} minutes', '%Y-%m-%d %H:%M:%S') AS window_end
    FROM closed
    """


_DRIBBLE_SQL = f"""
    WITH m AS ({_MATCHES}), counts AS (
        SELECT l_suppkey AS team_name, season_id, count(*) AS dribbles
        FROM lineitem JOIN m ON l_orderkey = match_id WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT *, lag(dribbles) OVER (PARTITION BY team_name ORDER BY season_id) AS prev_season_dribbles
    FROM counts
"""


def _places_sql(expression: str) -> str:
    return f"""
    SELECT event_id, event_type, {expression.format("(PARTITION BY event_type ORDER BY value DESC)")} AS place
    FROM events
    """


_ORACLE: dict[str, str] = {
    "b0_top_scorers": """
        SELECT user_id AS player_name, count(*) AS goals,
               row_number() OVER (ORDER BY count(*) DESC, user_id) AS rank
        FROM events WHERE event_type = 'purchase' GROUP BY user_id ORDER BY goals DESC, user_id LIMIT 10
    """,
    "b1_completion_running_avg": _completion_sql("ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"),
    "b2_avg_rank": _XG_SQL,
    "b3_lag": _DRIBBLE_SQL,
    "b4_linked_pairs": _assist_sql("count(*)", 9),
    "b5_percentile": _conversion_sql("DESC"),
    "b6_rolling_count": _PRESSING_SQL,
    "b7_diff_from_mean": """
        WITH means AS (SELECT l_suppkey AS team_name, avg(l_quantity) AS mean FROM lineitem GROUP BY ALL)
        SELECT team_name, round(mean, 6) AS team_avg_duration,
               round(avg(mean) OVER (), 6) AS league_avg_duration,
               round(mean - avg(mean) OVER (), 6) AS diff_from_league_avg
        FROM means
    """,
    "b8_rate_rank": _CROSS_SQL,
    "b9_growth": _GROWTH_SQL,
    "l1_enrich": """
        SELECT event_id, user_id, event_type, value, c_custkey, c_name, c_nationkey, c_mktsegment
        FROM events LEFT JOIN customer ON user_id = c_custkey
    """,
    "l2_tumbling": _window_sql(10, 10, "round(avg(value), 6) AS avg_value"),
    "l3_alerts": _window_sql(
        5, 1, "round(sum(value) + sum(k), 6) AS total_goals", "HAVING sum(value) + sum(k) > 60"
    ),
    "l4_form": _window_sql(
        30, 5, "round(sum(value), 6) AS goals_scored, CAST(sum(k) AS BIGINT) AS goals_conceded"
    ),
    "l5_attach": """
        SELECT event_id, user_id, event_type, value, c_custkey, c_name, c_nationkey, c_mktsegment
        FROM events LEFT JOIN customer ON user_id = c_custkey WHERE event_type = 'purchase'
    """,
    "p1_flatten_competitions": _COMPETITION_SQL,
    "p2_flatten": _MATCH_SQL,
    "p3_explode": _PLAYERS,
    "p3_explode_outer": f"""
        {_PLAYERS} UNION ALL
        SELECT o_orderkey, o_orderpriority, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus <> 'F'
    """,
    "p4_flatten_events": _EVENT_SQL,
    "p6_parse": """
        WITH scores AS (
            SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id % 7 <> 0 AS whole FROM events)
        SELECT CASE WHEN whole THEN CAST(user_id AS VARCHAR) END AS match_id,
               CASE WHEN whole THEN 'home' || user_id END AS home_team, CASE WHEN whole THEN 'away' || user_id END AS away_team,
               CASE WHEN whole THEN k END AS home_score, CASE WHEN whole THEN k % 7 END AS away_score,
               CASE WHEN whole THEN CAST(minute(ts) AS INTEGER) END AS minute,
               CASE WHEN whole THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp
        FROM scores
    """,
    "s1_json_events_multiline": _EVENT_SQL,
    "s3_json_matches": _MATCH_SQL,
    "s4_json_competitions": _COMPETITION_SQL,
    "s5_json_lineups": _PLAYERS,
    "s6_teams": "SELECT s_name AS team_name, CAST(s_nationkey AS VARCHAR) AS country FROM supplier",
    "s10_adhoc_sql": """
        SELECT CAST(year(o_orderdate) AS BIGINT) AS season_id, CAST(n_regionkey AS BIGINT) AS competition_id,
               count(*) AS passes, count(*) FILTER (WHERE l_returnflag = 'N') AS completed
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        WHERE l_linestatus = 'O' GROUP BY ALL
    """,
    "k1_curated": _DRIBBLE_SQL,
    "k5_incremental": _completion_sql("ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"),
    "k5_incremental_counterpress": _PRESSING_SQL,
    "k5_incremental_growth": _GROWTH_SQL,
    "k2_connector": _DRIBBLE_SQL,
    "k4_transformed": """
        SELECT user_id AS player_name, count(*) AS goals, max(event_id) AS last_event
        FROM events WHERE event_type = 'purchase' GROUP BY ALL
    """,
    "a8_diff_from_overall_mean": """
        WITH means AS (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY ALL)
        SELECT o_custkey, round(mean, 6) AS mean_price, round(avg(mean) OVER (), 6) AS overall,
               round(mean - avg(mean) OVER (), 6) AS diff
        FROM means
    """,
    "a2_sums_by_segment": """
        SELECT o_orderstatus, c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS price
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
    "t7_live_job": f"""
        SELECT 'avg_goals_per_10min' AS collection, 'home' || user_id AS who, first, CAST(NULL AS DOUBLE) AS second,
               window_start, window_end FROM ({_window_sql(10, 10, "round(avg(k), 6) AS first")})
        UNION ALL
        SELECT 'high_scoring_alerts', CAST(user_id AS VARCHAR), first, NULL, window_start, window_end
        FROM ({_window_sql(5, 1, "CAST(sum(k) + sum(k % 7) AS DOUBLE) AS first", "HAVING sum(k) + sum(k % 7) > 4")})
        UNION ALL
        SELECT 'team_form_30min', 'home' || user_id, first, second, window_start, window_end
        FROM ({_window_sql(30, 5, "CAST(sum(k) AS DOUBLE) AS first, CAST(sum(k % 7) AS DOUBLE) AS second")})
    """,
    "t5_late_rows": """
        WITH placed AS (SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS start FROM events),
        bounds AS (
            SELECT max(ts) FILTER (WHERE event_id % 2 = 0) - INTERVAL '1 minute' AS first_run,
                   max(ts) - INTERVAL '1 minute' AS second_run FROM events)
        SELECT user_id, round(avg(value), 6) AS avg_value, strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(start + INTERVAL '10 minutes', '%Y-%m-%d %H:%M:%S') AS window_end
        FROM placed, bounds
        WHERE (event_id % 2 = 0 OR start + INTERVAL '10 minutes' > first_run)
              AND start + INTERVAL '10 minutes' <= second_run
        GROUP BY start, user_id
    """,
    "w2_avg_decimal": """
        WITH sums AS (
            SELECT o_orderkey, o_orderstatus, row_number() OVER so_far AS n,
                   sum(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) * 100 AS BIGINT)) OVER so_far AS cents
            FROM orders
            WINDOW so_far AS (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))
        SELECT o_orderkey, o_orderstatus, CAST((cents * 20000 + n) // (2 * n) AS BIGINT) AS millionths FROM sums
    """,
    "w2_avg_long": """
        SELECT event_id, event_type, round(avg(event_id) OVER (
                   PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING), 6) AS mean
        FROM events
    """,
    "w3_dense_rank": _places_sql("dense_rank() OVER {}"),
    "w4_lag": """
        WITH days AS (
            SELECT CASE event_type WHEN 'click' THEN 'Pass' WHEN 'purchase' THEN 'Shot' ELSE event_type END
                       AS event_type_name,
                   CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS match_id,
                   count(*) AS n
            FROM events GROUP BY ALL)
        SELECT *, lag(n) OVER (PARTITION BY event_type_name ORDER BY match_id) AS n_before FROM days
    """,
    "w5_count_last_100": """
        SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY ts, event_id
                   ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS last_100
        FROM events
    """,
    "w6_percent_rank": _places_sql("round(percent_rank() OVER {}, 6)"),
    "w7_rank": _places_sql("rank() OVER {}"),
    "v_running_from_start": _completion_sql("ROWS UNBOUNDED PRECEDING"),
    "v_running_sum_from_start": """
        SELECT event_id, event_type, round(sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
                   ROWS UNBOUNDED PRECEDING), 6) AS so_far
        FROM events
    """,
    "v_sum_last_11": _assist_sql("sum(1)", 10),
    "v_counterpress_turnover": """
        WITH sides AS (
            SELECT l_orderkey, l_suppkey % 10 AS team_name, l_partkey % 10 AS holder, l_linestatus = 'F' AS counterpress,
                   lead(l_partkey % 10) OVER (PARTITION BY l_orderkey
                       ORDER BY l_linenumber, l_partkey, l_suppkey) AS next_holder
            FROM lineitem),
        counts AS (
            SELECT l_orderkey, team_name, count(*) AS turnovers FROM sides
            WHERE counterpress AND holder <> team_name AND next_holder = team_name GROUP BY ALL)
        SELECT team_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS match_date, turnovers,
               round(avg(turnovers) OVER (PARTITION BY team_name ORDER BY CAST(o_orderdate AS DATE), o_orderkey
                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) AS rolling_avg_turnovers
        FROM counts JOIN orders ON l_orderkey = o_orderkey
    """,
    "v_possession_duration": """
        WITH lasted AS (
            SELECT l_orderkey, l_linenumber % 2 AS possession, l_partkey % 10 AS possession_team_name,
                   sum(l_quantity) AS lasted
            FROM lineitem GROUP BY ALL),
        means AS (SELECT possession_team_name, avg(lasted) AS mean FROM lasted GROUP BY ALL)
        SELECT possession_team_name, round(mean, 6) AS team_avg_duration,
               round(avg(mean) OVER (), 6) AS league_avg_duration,
               round(mean - avg(mean) OVER (), 6) AS diff_from_league_avg
        FROM means
    """,
    "v_percentile_ascending": _conversion_sql("ASC"),
    "v_top3_dense": f"{_XG_SQL} WHERE rank_in_comp <= 3",
    "v_top5_rank": f"{_CROSS_SQL} WHERE rank_in_season <= 5",
}


def oracle_sql() -> dict[str, str]:
    return _ORACLE | (_llm.oracle_sql() if _llm else {})

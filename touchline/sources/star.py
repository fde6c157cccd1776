"""A retail star schema in the roles of match data, so that the reports run on it unchanged.

An order is a match, its year the season, the customer's region the competition. A line item is an
event of that match: supplier = team, brand = player, part type = position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.session import scratch
from touchline.sources.stream import read_stream, replay

# The tables' columns. Stating them saves a job per read, which would look them up.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def matches(spark: SparkSession, folder: str, placed: bool = True) -> DataFrame:
    """Orders as matches; ``placed`` adds the competition, at the price of joining the customers."""
    orders = table(spark, folder, "orders")
    roles = [
        F.col("o_orderkey").alias("match_id"),
        F.to_date("o_orderdate").alias("match_date"),
        F.year("o_orderdate").cast("long").alias("season_id"),
    ]
    if not placed:
        return orders.select(*roles)
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select(
        *roles, F.col("n_regionkey").cast("long").alias("competition_id")
    )


def competitions(spark: SparkSession, folder: str) -> DataFrame:
    """Each region in each season that it has matches in."""
    played = matches(spark, folder).select("competition_id", "season_id").distinct()
    regions = table(spark, folder, "region").select(
        F.col("r_regionkey").cast("long").alias("competition_id"), F.col("r_name").alias("competition_name")
    )
    return played.join(regions, "competition_id")


# Line items that are passes, and those that are goals or completed dribbles.
OPEN = "l_linestatus = 'O'"
RETURNED = "l_returnflag = 'R'"


def events(
    spark: SparkSession, folder: str, kind: str, parts: bool = False, only: str | None = None
) -> DataFrame:
    """Line items as events of one ``kind``.

    A shot scores and a dribble succeeds when the item was returned (R). Passes are the open items
    (O), all of them crosses, completed when not yet returnable (N). Fulfilled items (F) counter-press.
    ``parts`` adds player and position, at the price of a join. ``only`` says in the table's own
    columns what the report will filter by, so that the Parquet scan can skip by it.
    """
    items = table(spark, folder, "lineitem")
    if only is not None:
        items = items.where(only)
    roles = {
        "match_id": F.col("l_orderkey"),
        "team_name": F.col("l_suppkey"),
        "event_type_name": F.when(F.expr(OPEN), "Pass") if kind == "Pass" else F.lit(kind),
        "duration": F.col("l_quantity"),
        "counterpress": F.col("l_linestatus") == "F",
        "pass": F.struct(
            F.struct(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("name")).alias("outcome"),
            F.expr(OPEN).alias("cross"),
        ),
        "shot": F.struct(
            F.col("l_discount").alias("statsbomb_xg"),
            F.struct(F.when(F.expr(RETURNED), "Goal").otherwise("Saved").alias("name")).alias("outcome"),
        ),
        "dribble": F.struct(
            F.struct(
                F.when(F.expr(RETURNED), "Complete").otherwise("Incomplete").alias("name")
            ).alias("outcome")
        ),
    }
    if parts:
        items = items.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        roles |= {"player_name": F.col("p_brand"), "position_name": F.col("p_type")}
    return items.select(*[value.alias(name) for name, value in roles.items()])


def clicks(spark: SparkSession, folder: str, *kinds: str) -> DataFrame:
    """Web events: a click is an assist to the event its ``k`` names, a purchase is a goal.

    A day is a match, a user a player. ``kinds`` limits the types of event that are read.
    """
    kind = F.col("event_type")
    rows = table(spark, folder, "events")
    return (rows.where(kind.isin(*kinds)) if kinds else rows).select(
        F.unix_date(F.to_date("ts")).alias("match_id"),
        F.to_date("ts").alias("match_date"),
        "event_id",
        F.col("user_id").alias("player_name"),
        F.when(kind == "click", "Pass").when(kind == "purchase", "Shot").otherwise(kind).alias("event_type_name"),
        F.struct(
            F.get_json_object("props", "$.k").try_cast("long").alias("assisted_shot_id"),
            F.lit(True).alias("goal_assist"),
        ).alias("pass"),
        F.struct(F.struct(F.lit("Goal").alias("name")).alias("outcome")).alias("shot"),
    )


def click_days(spark: SparkSession, folder: str) -> DataFrame:
    """The days with clicks."""
    return clicks(spark, folder, "click").select("match_id", "match_date").distinct()


def live(spark: SparkSession, folder: str, timed: bool = False) -> DataFrame:
    """Web events as a stream of scores: ``value`` at home, ``k`` away.

    ``timed`` lets them come in the order of time, a part in each micro-batch, as windows with state want it.
    """
    if timed:
        path = scratch(spark, "live")
        replay(table(spark, folder, "events"), "ts", path)
        stream = read_stream(spark, "parquet", path, COLUMNS["events"], maxFilesPerTrigger="1")
    else:
        stream = read_stream(spark, "parquet", folder, COLUMNS["events"], pathGlobFilter="events.parquet")
    return stream.withColumns({
        "timestamp": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k").try_cast("int"),
    })

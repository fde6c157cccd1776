"""Running aggregates and ranks over chunks must equal the plain window over whole groups."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from touchline.operators import lagged, ordered, ranked, running
from touchline.operators.ordered import CHUNK, split
from touchline.session import pin


def _skewed(spark, seed, n=900, values=12):
    """One group of a third of the rows, one NULL group, tiny groups; values that tie, some NULL."""
    draw = random.Random(seed)
    groups = ["hot"] * (n // 3) + [None] * (n // 6) + [f"g{i % 97}" for i in range(n - n // 3 - n // 6)]
    data = [
        (g, draw.randrange(40), i, None if draw.random() < 0.05 else float(draw.randrange(values)))
        for i, g in enumerate(groups)
    ]
    draw.shuffle(data)
    return spark.createDataFrame(data, "g string, day int, id int, v double").repartition(5)


@pytest.mark.parametrize("fn", ["avg", "sum", "count"])
@pytest.mark.parametrize("n", [1, 2, 5, 200, None])
def test_running_equals_plain_window(spark, many_chunks, fn, n):
    df = _skewed(spark, 1)
    start = Window.unboundedPreceding if n is None else 1 - n
    plain = Window.partitionBy("g").orderBy("day", "id").rowsBetween(start, 0)
    expected = df.withColumn("r", F.round(getattr(F, fn)("v").over(plain), 9))
    actual = running(df, ["g"], ["day", "id"], "v", fn, n, "r").withColumn("r", F.round("r", 9))
    assert rows(actual, "g", "id", "r") == rows(expected, "g", "id", "r")


@pytest.mark.parametrize("kind,plain", [
    ("rank", F.rank), ("dense", F.dense_rank), ("percent", F.percent_rank),
])
@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("values", [1, 12, 10_000])
def test_ranked_equals_plain_window(spark, many_chunks, kind, plain, ascending, values):
    df = _skewed(spark, 2, values=values)
    sense = F.col("v").asc() if ascending else F.col("v").desc()
    expected = df.withColumn("r", plain().over(Window.partitionBy("g").orderBy(sense)))
    actual = ranked(df, ["g"], "v", ["id"], kind, ascending, "r")
    assert rows(actual, "g", "id", "r") == rows(expected, "g", "id", "r")


@pytest.mark.parametrize("kind,plain", [("rank", F.rank), ("dense", F.dense_rank)])
@pytest.mark.parametrize("values", [2, 12])
def test_top_keeps_all_ties(spark, many_chunks, kind, plain, values):
    df = _skewed(spark, 3, values=values)
    place = plain().over(Window.partitionBy("g").orderBy(F.col("v").desc()))
    expected = df.withColumn("r", place).where("r <= 3")
    actual = ranked(df, ["g"], "v", ["id"], kind, name="r", top=3)
    assert rows(actual, "g", "id", "r") == rows(expected, "g", "id", "r")


def test_several_keys(spark, many_chunks):
    df = _skewed(spark, 4).withColumn("h", F.col("id") % 2)
    plain = Window.partitionBy("g", "h").orderBy("day", "id").rowsBetween(-4, 0)
    expected = df.withColumn("r", F.count("*").over(plain))
    actual = running(df, ["g", "h"], ["day", "id"], None, "count", 5, "r")
    assert rows(actual, "g", "id", "r") == rows(expected, "g", "id", "r")


def test_hot_group_is_spread(spark, many_chunks):
    chunks = split(_skewed(spark, 5), ["g"], [F.col("day").asc(), F.col("id").asc()])
    sizes = [r["count"] for r in chunks.groupBy(CHUNK).count().collect()]
    assert len(sizes) == 7 and max(sizes) < 900 / 4
    assert chunks.where("g = 'hot'").select(CHUNK).distinct().count() >= 3


def test_only_large_groups_are_taken_apart(spark, many_chunks):
    df = pin(_skewed(spark, 5))
    assert rows(ordered.large_groups(df, ["g"])) == [(None,), ("hot",)]
    assert rows(ordered.large_groups(df.where("NOT g <=> 'hot'"), ["g"])) == [(None,)]
    assert ordered.large_groups(df.where("g like 'g%'"), ["g"]) is None
    # However few files the rows lie in.
    assert rows(ordered.large_groups(pin(df.coalesce(1)), ["g"])) == [(None,), ("hot",)]


# Large longs, whose sum leaves 64 bits while their mean doesn't.
_TYPES = {"int": "int(v)", "long": "bigint(v) * 10000000000000000", "decimal": "cast(v / 4 as decimal(10, 2))",
          "long decimal": "cast(v / 4 as decimal(14, 2))",
          "float": "float(v / 4)", "double": "v / 4"}


@pytest.mark.parametrize("kind", _TYPES)
@pytest.mark.parametrize("fn,n", [("avg", None), ("sum", None), ("count", None), ("avg", 3), ("sum", 3), ("count", 3)])
def test_type_and_value_do_not_depend_on_the_size(spark, many_chunks, monkeypatch, kind, fn, n):
    """Above the limit as the plain window, which is what runs below it."""
    df = _skewed(spark, 6).withColumn("v", F.expr(_TYPES[kind]))
    if (kind, fn, n) == ("long", "sum", None):
        df = df.withColumn("v", F.expr("v div 1000"))
    start = Window.unboundedPreceding if n is None else 1 - n
    plain = Window.partitionBy("g").orderBy("day", "id").rowsBetween(start, 0)
    expected = df.withColumn("r", getattr(F, fn)("v").over(plain))
    actual = running(df, ["g"], ["day", "id"], "v", fn, n, "r")
    assert actual.schema["r"].dataType == expected.schema["r"].dataType
    if n is None and fn == "avg":
        assert ordered.large_groups(pin(df), ["g"]) is not None
        monkeypatch.setattr(ordered, "large_groups", lambda *a: None)
        assert running(df, ["g"], ["day", "id"], "v", fn, n, "r").schema == actual.schema
    if kind == "long" and fn == "avg":  # the order of addition shows in the last bits of large doubles
        actual, expected = (x.withColumn("r", F.round(F.col("r") / 1e16, 9)) for x in (actual, expected))
    assert rows(actual, "g", "id", "r") == rows(expected, "g", "id", "r")


def test_bounded_groups_and_tops_run_nothing_yet(spark, monkeypatch):
    monkeypatch.setattr(ordered, "pin", lambda df: pytest.fail("written"))
    df = _skewed(spark, 7)
    for lazy in (running(df, ["g"], ["day", "id"], "v", bounded=True), ranked(df, ["g"], "v", ["id"], bounded=True),
                 ranked(df, ["g"], "v", ["id"], top=3)):
        assert lazy.count() > 0


def test_one_value_is_spread(spark, many_chunks):
    """All rows in one group with one value still fill all chunks."""
    df = spark.range(700).select(F.lit("g").alias("g"), F.col("id"), F.lit(1.0).alias("v"))
    chunks = split(df, ["g"], [F.col("v").desc(), F.col("id").asc()])
    assert chunks.select(CHUNK).distinct().count() == 7
    assert rows(ranked(df, ["g"], "v", ["id"], name="r").select("r").distinct()) == [(1,)]


def test_order_of_input_and_partitions_do_not_matter(spark, many_chunks):
    df = _skewed(spark, 6)
    before = rows(running(df, ["g"], ["day", "id"], "v", "avg", 5, "r"), "id", "r")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert rows(running(df.orderBy(F.rand(7)), ["g"], ["day", "id"], "v", "avg", 5, "r"), "id", "r") == before


def test_frame_of_one_row_is_the_row(spark):
    df = _skewed(spark, 8).where("v is not null")
    assert rows(running(df, ["g"], ["day", "id"], "v", "avg", 1, "r").where("r <> v")) == []


def test_frame_edges_of_an_average(spark):
    rates = [(i, float(1 - i % 2)) for i in range(6)]
    df = spark.createDataFrame([("t", *r) for r in rates], "g string, day int, v double")
    out = rows(running(df, ["g"], ["day"], "v", "avg", 5, "r"), "day", "r")
    assert [r for _, r in out] == pytest.approx([1, 1 / 2, 2 / 3, 1 / 2, 3 / 5, 2 / 5])


def test_ranks_with_a_tie(spark):
    df = spark.createDataFrame([("s", "a", 0.9), ("s", "b", 0.9), ("s", "c", 0.5)], "g string, id string, v double")
    got = {
        kind: [r for _, r in rows(ranked(df, ["g"], "v", ["id"], kind, name="r"), "id", "r")]
        for kind in ("rank", "dense", "percent")
    }
    assert got == {"rank": [1, 1, 3], "dense": [1, 1, 2], "percent": [0, 0, 1]}


def test_lag_of_the_first_is_null(spark):
    df = spark.createDataFrame([("p", 1, 5), ("p", 2, 7), ("q", 2, 1)], "g string, s int, n int")
    assert rows(lagged(df, ["g"], ["s"], "n", "before"), "g", "s", "before") == [
        ("p", 1, None), ("p", 2, 5), ("q", 2, None),
    ]


def test_wrong_arguments(spark):
    df = _skewed(spark, 9, n=12)
    with pytest.raises(ValueError):
        running(df, ["g"], ["id"], None, "avg")
    with pytest.raises(ValueError):
        running(df, ["g"], ["id"], "v", "median")
    with pytest.raises(ValueError):
        ranked(df, ["g"], "v", ["id"], "row")
    with pytest.raises(ValueError):
        ranked(df, ["g"], "v", ["id"], "percent", top=3)


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, day int, id int, v double")
    assert rows(running(df, ["g"], ["day", "id"], "v", "avg", 5, "r")) == []
    assert rows(ranked(df.where("v > 1"), ["g"], "v", ["id"], name="r", top=2)) == []

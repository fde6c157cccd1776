"""Every registered query against its SQL, on the smallest of the given tables."""

from functools import partial
from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from touchline.sources import replay, star

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


# The operators of the training-data subpackage have tests of their own.
OWN = sorted(contract._QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, db, name):
    assert difference(contract.queries()[name](spark, FOLDER), db, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["b1_completion_running_avg", "b4_linked_pairs", "b8_rate_rank", "w3_dense_rank",
                                  "w5_count_last_100", "w6_percent_rank", "v_running_sum_from_start"])
def test_query_over_many_chunks_equals_sql(spark, many_chunks, db, name):
    assert difference(contract.queries()[name](spark, FOLDER), db, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["l2_tumbling", "l3_alerts", "l4_form", "t7_live_job"])
def test_windows_over_many_micro_batches_equal_sql(spark, monkeypatch, db, name):
    monkeypatch.setattr(star if name[0] == "l" else contract, "replay", partial(replay, each=200))
    assert difference(contract.queries()[name](spark, FOLDER), db, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_every_query_has_its_sql():
    assert set(OWN) == contract._ORACLE.keys()

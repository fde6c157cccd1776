import json
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from touchline.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark, monkeypatch):
    """Keep every range partition and call groups beyond 50 rows large, so that they are cut."""
    from touchline.operators import ordered

    before = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions",
    )}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    monkeypatch.setattr(ordered, "GROUP_LIMIT", 50)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def dump(tmp_path):
    """Write records as one pretty-printed JSON array and return its path."""

    def write(name, records, indent=2):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(records, indent=indent))
        return str(path)

    return write


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])

"""Each query against its SQL in DuckDB: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 12) + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same bag of rows, else what differs."""
    result = db.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(columns)}"
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{actual.total()} rows against {expected.total()}; surplus {list(extra)[:3]}, "
        f"missing {list(missing)[:3]}"
    )


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as contract
    from touchline.session import build

    spark = build("compare", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    db, oracle, failed = connect(folder), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            problem = difference(query(spark, folder), db, oracle[name]) if name in oracle else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28} {time.perf_counter() - start:6.2f}s  {problem or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(min(main(folder, sys.argv[2:]), 1))

"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__  # noqa: E402
from conftest import SMALL  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()
# At the smallest scale these are rightly empty: too few keys, or no pair above the limit.
MAY_BE_EMPTY = {"detect_high_card", "unseen_keys", "stream_window_drift", "example_rows"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def text(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert rows or name in MAY_BE_EMPTY
    if name not in SQL:
        return
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(tuple(text(r[columns.index(c)]) for c in sorted(columns)) for r in cursor.fetchall())
    assert sorted(tuple(text(r[c]) for c in sorted(columns)) for r in rows) == expected


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 15

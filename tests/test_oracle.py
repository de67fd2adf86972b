"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from ledgermend.checks.oracle import ORACLE_SQL
from ledgermend.checks.registry import QUERIES, STORED

SCALE = os.environ.get("ORACLE_SF", "sf0.01")


@pytest.fixture(scope="module")
def duck(data_root):
    connection = duckdb.connect()
    for path in sorted((data_root / SCALE).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            assert not math.isnan(v)
            return repr(v)
        return repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def kind(value):
    return type(value).__name__


def test_every_query_has_a_counterpart():
    assert set(ORACLE_SQL) == set({**QUERIES, **STORED})


@pytest.mark.parametrize("name", [*QUERIES, *STORED])
def test_matches_sql(name, spark, duck, data_root):
    frame = {**QUERIES, **STORED}[name](spark, str(data_root / SCALE))
    expected = duck.execute(ORACLE_SQL[name])
    columns = [column[0] for column in expected.description]
    wanted = expected.fetchall()
    got = [tuple(row) for row in frame.collect()]
    assert sorted(frame.columns) == sorted(columns)
    assert len(got) == len(wanted) > 0
    assert canonical(got, frame.columns) == canonical(wanted, columns)

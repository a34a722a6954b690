"""Every registered query that has SQL gives the rows that DuckDB gives on the same tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir)
    want = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(want.fetchall(), names)

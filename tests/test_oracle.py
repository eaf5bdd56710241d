"""Every core query with oracle SQL against DuckDB on the smallest tables, whole."""

import math
from pathlib import Path

import duckdb
import pytest

from lodestream.plans import registry


def canonical(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, str)):
        return v
    try:
        v = float(v)
    except (TypeError, ValueError):
        return str(v)
    return None if math.isnan(v) else round(v, 6)


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf, duck, name):
    df = registry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(canonical(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(canonical(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", ["resolution_decisions", "sequence_ratio", "greedy_eval", "html_text"])
def test_without_oracle(spark, sf, name):
    assert registry.queries()[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_hard_tables(spark, hard_tables, name):
    """No query fails on empty tables, nulls, repeated rows or clashing names."""
    for folder in hard_tables:
        df = registry.queries()[name](spark, folder)
        rows = df.collect()
        if name.endswith("_found"):
            assert len(rows) == len(set(rows))
            assert not any(v is None for r in rows for v in r)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

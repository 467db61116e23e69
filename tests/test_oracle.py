"""Every registered query with SQL against DuckDB, on the smallest tables."""

import decimal

import duckdb
import pytest

from tallyforge.plans.oracle import oracle_sql
from tallyforge.plans.queries import queries


def plain(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    return str(v) if isinstance(v, decimal.Decimal) else v


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, name):
    df = queries()[name](spark, sf)
    rows = df.collect()
    if name not in oracle_sql():
        assert rows and name.startswith("imm_")
        return
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{sf}/events.parquet'")
    cursor = con.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(([plain(r[names.index(c)]) for c in sorted(names)] for r in cursor.fetchall()), key=repr)
    assert sorted(([plain(r[c]) for c in sorted(names)] for r in rows), key=repr) == want


def test_entry_names():
    import __spark_entry__ as entry

    assert set(queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())

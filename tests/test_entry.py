import importlib

import pytest

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    out = df.collect()
    assert len(out) >= 1
    assert "prediction_drift" in df.columns


def test_every_oracle_has_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    from tabflow.plans.registry import ORACLE_SQL, QUERIES

    assert set(ORACLE_SQL) == set(QUERIES)


def _names():
    return sorted(importlib.import_module("__spark_entry__").queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle_sf0001(spark, sf_small, name):
    """Every registered query against its DuckDB oracle on the smallest tables."""
    import duckdb

    from scripts.check_oracle import TABLES, digest, rows_of

    df = entry_mod.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    sql = entry_mod.oracle_sql().get(name)
    if sql is None:
        assert len(srows) > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    sc, sr = rows_of(df.columns, srows)
    dc, dr = rows_of(dcols, res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert digest(sr) == digest(dr)

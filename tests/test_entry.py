"""Driver contract: entry and every registered query run at sf0.001 with
the oracle's column names."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry_mod
from fraudmart import schemas
from fraudmart.plans import registry

from planted_cases import SF001

TABLES = ["nation", "customer", "supplier", "events"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == schemas.REPORT_COLUMNS
    assert df.count() > 0


def test_every_query_has_oracle_with_same_columns(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(registry.QUERIES) <= set(qs) and set(sqls) <= set(qs)
    rows = {}
    for name, fn in registry.QUERIES.items():
        df = fn(spark, SF001)
        cols = con.sql(sqls[name]).columns
        assert sorted(df.columns) == sorted(cols), name
        rows[name] = df.count()
        assert rows[name] == con.sql(f"SELECT count(*) FROM ({sqls[name]})").fetchall()[0][0], name
    assert rows["fraud_amount_guess_dense"] > 0 and rows["stream_amount_guess_dense"] > 0

"""The correctness gate: every query with an oracle equals DuckDB's result on
the same tables (row count, column names, order-insensitive values)."""

import duckdb
import pytest

from cargolens.plans.catalog import registry
from cargolens.plans.oracle_sql import ORACLE
from tools.oracle_check import TABLES, digest

NAMES = sorted(n for n in registry() if n in ORACLE)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(registry())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf_small, con, name):
    df = registry()[name](spark, sf_small)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]

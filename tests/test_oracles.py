"""Every query with an oracle matches DuckDB on sf0.001 (the driver's gate at small scale)."""

import duckdb
import pytest

from conftest import SF001
from tools.check_oracles import TABLES, digest

import __spark_entry__ as E

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLES[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    sc, sh, _ = digest(df.columns, srows)
    oc, oh, _ = digest(ocols, orows)
    assert sc == oc
    assert len(srows) == len(orows)
    assert sh == oh

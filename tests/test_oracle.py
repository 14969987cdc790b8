"""Every registered query against its DuckDB oracle on the smallest tables.

Same comparison as the correctness gate: row count, column names and an
order-insensitive hash of the values.  Queries without SQL form (metadata
checks) only need to run.
"""

import os
import re
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import TABLES, digest  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

# The training-data operators have their own tests.
QUERIES = {k: q for k, q in E.queries().items() if k != "pipeline" and not re.match(r"op\d+_", k)}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 80
    assert len(df.columns) == 12


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(ORACLE)


def test_broken_input_fails_its_checks(con):
    for name in (n for n in QUERIES if n.endswith("_broken")):
        rel = con.execute(ORACLE[name])
        cols = [d[0] for d in rel.description]
        rows = [dict(zip(cols, r)) for r in rel.fetchall()]
        assert any(r.get("failed_rows") or r.get("gap") or r.get("fault") or r.get("severity") for r in rows), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        return
    rel = con.execute(ORACLE[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]

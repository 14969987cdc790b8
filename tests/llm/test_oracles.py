"""Registered queries against their SQL, and against the tables' brute-force readings."""

import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def entry():
    import __spark_entry__

    return __spark_entry__


NAMES = [
    "op1_line_dedup",
    "op2_secret_scans",
    "op4_benchmark_decontamination",
    "op7_chat_formatting",
    "op8_url_filters",
    "op11_exact_dedup",
    "op12_phrase_collocations",
    "op13_source_divergence",
]


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, name):
    got = entry().queries()[name](spark, SF)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({entry().oracle_sql()[name]})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert rows


def test_all_registered():
    names = list(entry().queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names

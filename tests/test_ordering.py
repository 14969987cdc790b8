"""Distributed ordering primitives against brute force on small fixtures."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from enrolmart.operators.ordering import exact_quantiles, with_position, with_previous


def test_with_position_matches_sort(spark):
    rows = [(i % 7, f"k{(i * 37) % 101:03d}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    out = with_position(df, [F.col("a").asc(), F.col("b").desc(), F.col("c").asc()], n_ranges=5).collect()
    want = sorted(rows, key=lambda r: (r[0], [-ord(ch) for ch in r[1]], r[2]))
    got = sorted(out, key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(1, 501))
    assert [(r.a, r.b, r.c) for r in got] == want


def test_with_position_hot_key(spark):
    # a third of all rows share one key value
    rows = [(0 if i % 3 == 0 else i, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, t int")
    out = with_position(df, [F.col("k"), F.col("t")], n_ranges=8).collect()
    want = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {(r.k, r.t): r.pos for r in out} == want


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=80),
    st.lists(st.integers(0, 3), min_size=1, max_size=80),
)
def test_exact_quantiles_bruteforce(spark, values, hot):
    data = [("a", float(v) if v is not None else None) for v in values] + [("b", float(h)) for h in hot]
    df = spark.createDataFrame(data, "k string, v double")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = {r.k: [r[f"q_{i}"] for i in range(len(probs))] for r in exact_quantiles(df, "k", "v", probs, n_ranges=3).collect()}
    for key in ("a", "b"):
        xs = [v for k, v in data if k == key and v is not None]
        if not xs:
            assert key not in got
            continue
        want = [float(np.quantile(np.array(xs), p, method="linear")) for p in probs]
        assert np.allclose(got[key], want), (key, got[key], want)


def test_identical_rows_spread_over_ranges(spark):
    # nine rows of ten are the same row
    rows = [(1, "same")] * 9000 + [(i, f"r{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, t string")
    out = with_position(df, [F.col("k")], n_ranges=8)
    got = out.collect()
    assert sorted(r.pos for r in got) == list(range(1, 10_001))
    ranges = [len(p) for p in out.rdd.glom().collect() if p]
    assert len(ranges) == 8 and max(ranges) < 2500


def test_range_count_follows_the_setting(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 97)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        for n in (3, 11):
            spark.conf.set(key, str(n))
            out = with_position(df, [F.col("k"), F.col("id")])
            assert len([p for p in out.rdd.glom().collect() if p]) == n
    finally:
        spark.conf.set(key, before)


def test_with_previous_carries_over_the_ranges(spark):
    rows = [(i % 7, f"k{(i * 37) % 101:03d}", None if i % 11 == 0 else i) for i in range(500)] + [(1, "same", 5)] * 40
    df = spark.createDataFrame(rows, "a int, b string, c int")
    order = [F.col("a").asc(), F.col("b").desc(), F.col("c").asc_nulls_last()]
    for n in (1, 6, 40):
        out = sorted(with_previous(df, order, "c", "before", n_ranges=n).collect(), key=lambda r: r.pos)
        assert [r.pos for r in out] == list(range(1, 541))
        assert sorted(map(repr, [(r.a, r.b, r.c) for r in out])) == sorted(map(repr, rows))
        assert [r.before for r in out] == [None, *[r.c for r in out[:-1]]]
    assert with_previous(df.limit(0), order, "c", "before").collect() == []


def test_with_previous_joins_no_rows(spark):
    df = spark.range(100).select("id", (F.col("id") * 3).alias("v"))
    out = with_previous(df, [F.col("id")], "v", "before", n_ranges=4)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") == 1

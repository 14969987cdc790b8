"""Scalar expressions: numeric coercion, month parsing, rates, formatting."""

import math
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from enrolmart.functions.expr import (
    NUMERIC_PATTERN,
    coerce_double,
    coerce_double_sql,
    format_count,
    format_rate,
    month_no,
    pct1,
    report_date,
)

COERCE_CASES = [
    ("12", 12.0),
    (" 12 ", 12.0),
    ("", None),
    ("*", None),
    ("1,234", None),
    ("NaN", None),
    ("1e5", 100000.0),
    ("12d", None),
    ("12f", None),
    ("-", None),
    (None, None),
    ("-3.5", -3.5),
    (".5", 0.5),
    ("Infinity", None),
    ("1e400", None),
    ("-1e400", None),
    ("9" * 400, None),
    ("0" * 400 + "7", 7.0),
]


def test_coerce_cases(spark):
    df = spark.createDataFrame([(s,) for s, _ in COERCE_CASES], "x string")
    got = df.select("x", coerce_double("x").alias("a"), F.expr(coerce_double_sql("x")).alias("b")).collect()
    want = dict(COERCE_CASES)
    for row in got:
        assert row.a == want[row.x], row
        assert row.b == want[row.x], row


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+-eEdfNa ,*x\t\n", max_size=8), min_size=1, max_size=30))
def test_coerce_matches_pattern_and_python(spark, values):
    """Coercion equals: pattern match, then Python float parsing."""
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r.y for r in df.select(coerce_double("x").alias("y")).collect()]
    pat = re.compile(NUMERIC_PATTERN)
    for v, g in zip(values, got):
        want = float(v) if pat.match(v) else None
        want = None if want is None or math.isinf(want) else want
        if want is None or g is None:
            assert g == want, (v, g)
        else:
            assert math.isclose(g, want, rel_tol=1e-15), (v, g)


MONTH_CASES = [
    ("January", 1),
    ("February", 2),
    ("March", 3),
    ("April", 4),
    ("May", 5),
    ("June", 6),
    ("July", 7),
    ("August", 8),
    ("September", 9),
    ("October", 10),
    ("November", 11),
    ("December", 12),
    ("Year", None),
    ("january", None),
    ("Jan", None),
    (None, None),
]


def test_month_cases(spark):
    df = spark.createDataFrame([(m, 2020) for m, _ in MONTH_CASES], "month string, year int")
    rows = df.select("month", month_no("month").alias("n"), report_date("year", "month").alias("d")).collect()
    want = dict(MONTH_CASES)
    for r in rows:
        assert r.n == want[r.month]
        if want[r.month] is None:
            assert r.d is None
        else:
            assert (r.d.year, r.d.month, r.d.day) == (2020, want[r.month], 1)


RATE_CASES = [
    # (part, whole, expected one-decimal percent)
    (1.0, 0.0, None),
    (1.0, None, None),
    (None, 4.0, None),
    (0.25, 100.0, Decimal("0.3")),
    (1.25, 100.0, Decimal("1.3")),
    (7.0, 16.0, Decimal("43.8")),
    (1.005, 10.0, Decimal("10.1")),
    (1.0, 3.0, Decimal("33.3")),
    (2.0, 3.0, Decimal("66.7")),
]


def test_rate_cases(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in RATE_CASES], "a double, b double")
    rows = df.select(pct1("a", "b").alias("r")).collect()
    assert [r.r for r in rows] == [w for _, _, w in RATE_CASES]
    assert df.select(pct1("a", "b")).schema[0].dataType.simpleString() == "decimal(18,1)"


def test_formatting(spark):
    df = spark.createDataFrame([(1234567.0, Decimal("54.3")), (12.0, Decimal("5.0"))], "x double, r decimal(18,1)")
    rows = df.select(format_count("x").alias("c"), format_rate("r").alias("p")).collect()
    assert [(r.c, r.p) for r in rows] == [("1,234,567", "54.3%"), ("12", "5.0%")]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["abc", "20x1"])
def test_bad_year_raises(spark, bad, ansi):
    from enrolmart.operators.staging import stg
    from enrolmart.schemas import DIMENSIONS, MEASURES

    row = [bad, "January", "National", "US", "National", "Total", "00000"] + [1.0] * len(MEASURES)
    schema = ", ".join(f"{c} string" for c in DIMENSIONS) + ", " + ", ".join(f"{m} double" for m in MEASURES)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="invalid year|CAST"):
            stg(spark.createDataFrame([row], schema)).collect()
        good = stg(spark.createDataFrame([["2020"] + row[1:], [None] + row[1:]], schema)).collect()
        assert [r.year for r in good] == [2020, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)

"""Data checks on clean data and on planted violations; mart filters under NULLs."""

from pyspark.sql import functions as F

from enrolmart.operators import quality
from enrolmart.operators.marts import by_state, national
from enrolmart.operators.staging import stg
from enrolmart.schemas import DIMENSIONS, GEO_LEVELS, MEASURES, NATIONAL, VARCHAR_LIMITS

RAW_DDL = ", ".join(f"{c} string" for c in DIMENSIONS) + ", " + ", ".join(f"{m} double" for m in MEASURES)


def raw_rows(spark, rows):
    """rows: (year, month, level, state, county, tot, ma, ffs) -> typed raw DataFrame."""
    out = []
    for y, m, lvl, stt, cty, tot, ma, ffs in rows:
        measures = [None] * len(MEASURES)
        measures[0], measures[1], measures[2] = tot, ffs, ma
        out.append([y, m, lvl, stt, f"STATE_{stt}", cty, "00001"] + measures)
    return spark.createDataFrame(out, RAW_DDL)


def checks_dict(df):
    return {r.check: r.failed_rows for r in df.collect()}


def test_not_null_and_lengths(spark):
    raw = raw_rows(
        spark,
        [
            ("2020", "January", "National", "US", "Total", 10.0, 6.0, 4.0),
            ("2020", None, "National", "US", "Total", 10.0, 6.0, 4.0),
            ("2020", "February", None, "USA", "Total", 10.0, 6.0, 4.0),
        ],
    )
    got = checks_dict(quality.not_null(stg(raw), "stg", ["year", "month", "bene_geo_lvl"]))
    assert got == {"stg.year.not_null": 0, "stg.month.not_null": 1, "stg.bene_geo_lvl.not_null": 1}
    lengths = checks_dict(quality.max_lengths(raw, "raw", VARCHAR_LIMITS))
    assert lengths["raw.bene_state_abrvtn.max_length_2"] == 1
    assert sum(lengths.values()) == 1


def test_unique_and_combination(spark):
    # key_cases: an exact duplicate, a duplicate with a NULL part, a unique row
    df = spark.createDataFrame(
        [(2020, "January"), (2020, "January"), (None, "March"), (None, "March"), (2021, "May")],
        "year int, month string",
    )
    assert checks_dict(quality.unique_combination(df, "t", ["year", "month"])) == {
        "t.year_month.unique_combination": 2
    }
    # unique ignores NULL values
    assert checks_dict(quality.unique(df, "t", "year")) == {"t.year.unique": 1}


def test_accepted_values(spark):
    # level_cases: a fourth level value and a NULL level
    df = spark.createDataFrame([("National",), ("State",), ("County",), ("Region",), (None,), ("Region",)], "lvl string")
    assert checks_dict(quality.accepted_values(df, "stg", "lvl", GEO_LEVELS)) == {"stg.lvl.accepted_values": 1}


def test_min_rows_and_parity(spark):
    df = spark.range(5)
    assert checks_dict(quality.min_rows(df, "t", 10)) == {"t.min_rows_10": 1}
    assert checks_dict(quality.min_rows(df, "t", 5)) == {"t.min_rows_5": 0}
    assert checks_dict(quality.row_parity(df, spark.range(3), "load")) == {"load.row_parity": 2}


def test_state_exclusion_three_valued(spark):
    # state_cases: 'UK', NULL state, valid state; a NULL month on a national row
    raw = raw_rows(
        spark,
        [
            ("2020", "Year", "State", "UK", "Total", 10.0, 6.0, 4.0),
            ("2020", "Year", "State", None, "Total", 10.0, 6.0, 4.0),
            ("2020", "Year", "State", "AA", "Total", 8.0, 2.0, 6.0),
            ("2020", "January", "State", "AB", "Total", 8.0, 2.0, 6.0),
            ("2020", None, "National", "US", "Total", 8.0, 2.0, 6.0),
            ("2020", "March", "National", "US", "Total", 0.0, 0.0, 0.0),
        ],
    )
    s = stg(raw)
    assert [r.state for r in by_state(s).collect()] == ["AA"]
    nat = national(s).collect()
    assert len(nat) == 1 and nat[0].ma_penetration_rate is None  # zero total -> NULL rate
    assert national(s).schema == NATIONAL


def test_missing_columns_and_contract(spark):
    df = spark.createDataFrame([("a", 1)], "YEAR string, tot_benes int")
    got = [r.column_name for r in quality.missing_columns(df, "landed", ("year", "month", "TOT_BENES"), "error").collect()]
    assert got == ["month"]
    rows = quality.contract(df, "x", NATIONAL).collect()
    assert not any(r.ok for r in rows) and len(rows) == len(NATIONAL.fields)


def test_assert_checks(spark):
    import pytest

    ok = spark.createDataFrame([("a", 0)], "check string, failed_rows bigint")
    quality.assert_checks(ok)
    with pytest.raises(AssertionError):
        quality.assert_checks(ok.withColumn("failed_rows", F.lit(3).cast("bigint")))


def test_enforce_columns(spark):
    import pytest

    rows = [("landed.required_columns", "AGED_ESRD_BENES", "warn")]
    found = spark.createDataFrame(rows, "check string, column_name string, severity string")
    assert quality.enforce_columns(found) == ["AGED_ESRD_BENES"]
    bad = spark.createDataFrame(rows + [("landed.required_columns", "YEAR", "error")], found.schema)
    with pytest.raises(ValueError):
        quality.enforce_columns(bad)


def test_distinct_counts_exact_and_approx(spark):
    from enrolmart.operators import profile

    df = spark.createDataFrame([(i % 7, None if i % 5 == 0 else f"s{i % 11}") for i in range(300)], "a int, b string")
    exact = profile.distinct_counts(df, {"a": "na", "b": "nb"}).collect()[0]
    assert (exact.na, exact.nb) == (7, 11)
    approx = profile.distinct_counts(df, {"a": "na", "b": "nb"}, approx_rsd=0.01).collect()[0]
    assert (approx.na, approx.nb) == (7, 11)  # small cardinalities are counted exactly by the sketch

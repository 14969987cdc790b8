"""The star-schema adapter: sizes per level and the two 'national' tests agree."""

from pyspark.sql import functions as F

from enrolmart.plans import reports
from enrolmart.plans.relations import release

from conftest import SF_SMALL

# Level sizes of the derived release at sf0.001:
# level -> (monthly rows, annual rows, monthly suppressed totals, annual suppressed totals)
SIZES = {
    "National": (80, 7, 0, 0),
    "State": (1015, 174, 0, 0),
    "County": (1323, 543, 1308, 312),
}


def test_level_sizes(spark):
    landed = release(spark, SF_SMALL).landed
    rows = landed.groupBy("bene_geo_lvl").agg(
        F.count_if(F.col("month") != "Year").alias("m"),
        F.count_if(F.col("month") == "Year").alias("y"),
        F.count_if((F.col("month") != "Year") & (F.col("tot_benes") == "*")).alias("ms"),
        F.count_if((F.col("month") == "Year") & (F.col("tot_benes") == "*")).alias("ys"),
    ).collect()
    assert {r.bene_geo_lvl: (r.m, r.y, r.ms, r.ys) for r in rows} == SIZES
    assert landed.count() == 3142


def test_two_national_tests_agree(spark):
    rel = release(spark, SF_SMALL)
    by_level = {r.report_date: r.total_beneficiaries for r in rel.national().collect()}
    by_desc = {r.report_date: (r.tot_benes, r.n_rows) for r in reports.national_total_by_date(rel.raw).collect()}
    assert by_level.keys() == by_desc.keys()
    assert all(by_desc[d] == (v, 1) for d, v in by_level.items())


def test_shares_need_not_sum_to_100(spark):
    rel = release(spark, SF_SMALL)
    sums = {float(r.ma_penetration_rate + r.ffs_penetration_rate) for r in rel.national().collect()}
    assert sums <= {99.9, 100.0, 100.1}


def test_checks_pass_on_release(spark):
    import __spark_entry__ as E

    q = E.queries()
    for name in ("dq_not_null", "dq_unique", "dq_unique_combo", "dq_accepted_values", "dq_lengths"):
        assert all(r.failed_rows == 0 for r in q[name](spark, SF_SMALL).collect()), name
    from enrolmart.operators import quality
    from enrolmart.schemas import CONTRACTS

    r = release(spark, SF_SMALL)
    rels = {"raw": r.raw, "stg": r.stg, "national": r.national(), "by_state": r.by_state()}
    for name, df in rels.items():
        contract = quality.contract(df, name, CONTRACTS[name]).collect()
        assert contract and all(row.ok for row in contract), name

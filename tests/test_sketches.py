"""Stored sketches and catalog views."""

import pytest
from pyspark.sql import functions as F

from enrolmart.operators import sketches
from enrolmart.operators.marts import national
from enrolmart.plans.relations import release
from enrolmart.schemas import RAW
from enrolmart.sources import catalog, writers

from conftest import SF_SMALL


def test_merged_sketches_lie_within_the_bound(spark, tmp_path):
    root = str(tmp_path)
    months = {f"2025-{m:02d}": spark.range(m * 4000, m * 4000 + 9000).select("id", (F.col("id") % 70).alias("k")) for m in (1, 2, 3)}
    for label, df in months.items():
        sketches.write_sketches(df, root, label, ["id", "k"])

    def told(labels):
        return {r.column_name: r.estimate for r in sketches.distinct_estimates(spark, root, labels).collect()}

    for labels, exact in ((["2025-01"], 9000), (list(months), 17000)):
        got = told(labels)
        assert abs(got["id"] - exact) <= exact * sketches.error_bound()
        assert abs(got["k"] - 70) <= 1
    # A label written again replaces its sketches.
    sketches.write_sketches(spark.range(5).select("id", F.lit(1).alias("k")), root, "2025-03", ["id", "k"])
    assert told(["2025-03"]) == {"id": 5, "k": 1}


def test_nulls_and_no_rows_count_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "x int, y string")
    sketches.write_sketches(df, str(tmp_path), "a", ["x", "y"])
    sketches.write_sketches(df.limit(0), str(tmp_path), "b", ["x", "y"])
    got = {r.column_name: r.estimate for r in sketches.distinct_estimates(spark, str(tmp_path), ["a", "b"]).collect()}
    assert got == {"x": 0, "y": 1}


@pytest.fixture
def views(spark, tmp_path):
    raw = release(spark, SF_SMALL).raw
    names = catalog.create_views(spark, raw, "t_views", str(tmp_path / "t"))
    yield names, raw
    catalog.drop_views(spark, names)


def test_views_resolve_in_another_session_and_push_down(spark, views, tmp_path):
    names, raw = views
    other = spark.newSession()
    got = other.table(names["monthly"])
    assert got.count() == raw.where("month <> 'Year'").count()
    assert other.table(names["annual"]).count() == raw.where("month = 'Year'").count()
    p = got.where("bene_geo_lvl = 'National'").select("year", "month")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "EqualTo(bene_geo_lvl,Nation" in p
    assert "tot_benes" not in p  # three columns are read
    a, b = national(spark.table(names["stg"])), release(spark, SF_SMALL).national()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    # A reload of the table shows through the view.
    writers.full_reload(spark, raw.where("bene_geo_lvl = 'National'"), names["raw"], str(tmp_path / "t"), RAW)
    assert spark.table(names["monthly"]).where("bene_geo_lvl <> 'National'").isEmpty()

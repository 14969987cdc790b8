"""Sources and sinks: round trips in fresh folders, load strategies, landing checks."""

import os

import pytest
from pyspark.sql import functions as F

from enrolmart.plans.relations import release
from enrolmart.schemas import NATIONAL, RAW
from enrolmart.sources import readers, writers

from conftest import SF_SMALL


def _landed(spark):
    return release(spark, SF_SMALL).landed


def test_release_skip_force_latest(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "enrollment")
    with pytest.raises(FileNotFoundError):
        readers.latest_release(spark, root)  # empty root
    raw = release(spark, SF_SMALL).raw
    n = raw.count()
    assert writers.write_release(raw.limit(5), root, "2025-11")
    assert writers.write_release(raw, root, "2025-12")
    assert not writers.write_release(raw.limit(1), root, "2025-12")  # kept
    assert readers.releases(spark, root) == ["2025-11", "2025-12"]
    latest = readers.latest_release(spark, root)
    assert latest.count() == n
    assert "PartitionFilters: [isnotnull(release" in latest._jdf.queryExecution().executedPlan().toString()
    assert writers.write_release(raw.limit(1), root, "2025-12", force=True)
    assert readers.latest_release(spark, root).count() == 1


def test_landing_pages_gaps_and_drift(spark, tmpdir_fresh):
    landing = os.path.join(tmpdir_fresh, "landing")
    landed = _landed(spark)
    n = landed.count()
    writers.land_pages(landed, landing, page_size=1000)
    gaps = readers.page_gaps(spark, landing).orderBy("page_offset").collect()
    assert [g.page_offset for g in gaps] == list(range(0, n, 1000))
    assert not any(g.gap for g in gaps)
    assert readers.read_landing(spark, landing).count() == n
    # plant a missing page and a page lacking a measure column
    broken = os.path.join(tmpdir_fresh, "broken")
    src = readers.landed_json(spark, landing)
    kept = src.where(F.col("page_offset") != 1000).drop("AGED_ESRD_BENES")
    kept.write.partitionBy("page_offset").json(broken)
    gaps = {g.page_offset: g.gap for g in readers.page_gaps(spark, broken).collect()}
    assert 1000 not in gaps and gaps[2000] is True and gaps[0] is False
    drift = readers.empty_columns(readers.landed_json(spark, broken), "landed", ["AGED_ESRD_BENES", "TOT_BENES"], "warn")
    assert [r.column_name for r in drift.collect()] == ["AGED_ESRD_BENES"]


def test_full_reload_and_load_if_empty(spark, tmpdir_fresh):
    raw = release(spark, SF_SMALL).raw
    n = raw.count()
    loc = os.path.join(tmpdir_fresh, "t1")
    assert writers.full_reload(spark, raw.limit(3), "t_reload", loc, RAW) == 3
    assert writers.full_reload(spark, raw, "t_reload", loc, RAW) == n  # replaced, not appended
    loc2 = os.path.join(tmpdir_fresh, "t2")
    assert writers.load_if_empty(spark, raw.limit(2), "t_empty", loc2, RAW)
    assert not writers.load_if_empty(spark, raw, "t_empty", loc2, RAW)
    assert spark.table("t_empty").count() == 2
    assert writers.load_if_empty(spark, raw, "t_empty", loc2, RAW, force=True)
    assert spark.table("t_empty").count() == n


def test_csv_export_roundtrip_and_order(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "export")
    nat = release(spark, SF_SMALL).national()
    writers.export_csv(nat, path, ["report_date"])
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    back = readers.read_csv(spark, path, NATIONAL)
    assert back.schema == NATIONAL
    dates = [r.report_date for r in back.collect()]
    assert dates == sorted(dates)
    assert sorted(back.collect()) == sorted(nat.collect())


def test_export_both_marts(spark, tmpdir_fresh):
    from enrolmart.schemas import BY_STATE

    rel = release(spark, SF_SMALL)
    paths = writers.export_marts(rel.national(), rel.by_state(), os.path.join(tmpdir_fresh, "exports"))
    back = readers.read_csv(spark, paths["by_state"], BY_STATE)
    rows = back.collect()
    assert rows == sorted(rows, key=lambda r: (r.year, r.state))
    assert sorted(rows) == sorted(rel.by_state().collect())


def test_legacy_nulls(spark):
    df = spark.createDataFrame([(0.0, 0, "", "x"), (1.5, 2, "a", "")], "d double, l bigint, s string, t string")
    rows = writers.legacy_nulls(df).collect()
    assert tuple(rows[0]) == (None, 0, None, "x")
    assert tuple(rows[1]) == (1.5, 2, "a", None)


def test_clustered_write(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "clustered")
    raw = release(spark, SF_SMALL).raw
    writers.clustered_write(raw, path, n_files=4)
    back = readers.scan_release(spark, path)
    assert back.count() == raw.count()
    # each file holds a contiguous range of states
    per_file = back.groupBy(F.input_file_name().alias("f")).agg(
        F.min("bene_state_abrvtn").alias("lo"), F.max("bene_state_abrvtn").alias("hi")
    ).orderBy("lo").collect()
    for a, b in zip(per_file, per_file[1:]):
        assert a.hi <= b.lo


def test_incremental_landing_stream(spark, tmpdir_fresh):
    from enrolmart.streaming.landing import ingest_available

    landing = os.path.join(tmpdir_fresh, "landing")
    landed = _landed(spark)
    writers.land_pages(landed, landing, page_size=1000)
    target = os.path.join(tmpdir_fresh, "typed")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    first = ingest_available(spark, landing, target, ckpt).count()
    assert first == landed.count()
    # running again with no new pages adds nothing (exactly-once by checkpoint)
    assert ingest_available(spark, landing, target, ckpt).count() == first


def test_incremental_landing_picks_up_new_pages(spark, tmpdir_fresh):
    from enrolmart.streaming.landing import ingest_available

    src = os.path.join(tmpdir_fresh, "all")
    writers.land_pages(_landed(spark), src, page_size=500)
    pages = readers.landed_json(spark, src)
    total = pages.count()
    landing = os.path.join(tmpdir_fresh, "landing")
    target = os.path.join(tmpdir_fresh, "typed")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    # the first pages arrive, are ingested; the rest arrive later
    pages.where(F.col("page_offset") < 1500).write.partitionBy("page_offset").json(landing)
    first = ingest_available(spark, landing, target, ckpt).count()
    assert 0 < first < total
    pages.where(F.col("page_offset") >= 1500).write.mode("append").partitionBy("page_offset").json(landing)
    assert ingest_available(spark, landing, target, ckpt).count() == total


def _fails(df):
    """df with a last row whose evaluation fails."""
    bad = df.limit(1).withColumn("bene_geo_lvl", F.expr("CAST(raise_error('planted') AS STRING)"))
    return df.unionByName(bad)


def test_crashed_and_foreign_releases(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "rel")
    raw = release(spark, SF_SMALL).raw
    os.makedirs(os.path.join(root, "release=2025-12", "_temporary"))  # a write that crashed
    with pytest.raises(FileNotFoundError):
        readers.latest_release(spark, root)
    assert writers.write_release(raw.limit(4), root, "2025-11")
    raw.limit(2).write.parquet(os.path.join(root, "release=tmp-backup"))
    assert readers.releases(spark, root) == ["2025-11"]
    assert readers.latest_release(spark, root).count() == 4
    assert writers.write_release(raw.limit(5), root, "2025-12")  # the crashed one is rewritten
    assert readers.latest_release(spark, root).count() == 5
    lake = os.path.join(tmpdir_fresh, "lake")
    os.makedirs(os.path.join(lake, "release=2025-12", "_temporary"))
    assert writers.write_lake(raw.limit(3), lake, "2025-12")
    assert spark.read.parquet(lake).count() == 3


def test_failed_force_keeps_the_release(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "rel")
    raw = release(spark, SF_SMALL).raw
    writers.write_release(raw.limit(6), root, "2025-12")
    with pytest.raises(Exception, match="planted"):
        writers.write_release(_fails(raw), root, "2025-12", force=True)
    assert readers.latest_release(spark, root).count() == 6
    assert os.listdir(root) == ["release=2025-12"]


def test_failed_reload_keeps_the_table(spark, tmpdir_fresh):
    raw = release(spark, SF_SMALL).raw
    loc = os.path.join(tmpdir_fresh, "t")
    assert writers.full_reload(spark, raw.limit(5), "t_failing", loc, RAW) == 5
    with pytest.raises(Exception, match="planted"):
        writers.full_reload(spark, _fails(raw), "t_failing", loc, RAW)
    assert spark.table("t_failing").count() == 5
    assert len(os.listdir(loc)) == 1


def test_reload_replaces_a_changed_schema(spark, tmpdir_fresh):
    from pyspark.sql import types as T

    raw = release(spark, SF_SMALL).raw
    loc = os.path.join(tmpdir_fresh, "t")
    writers.full_reload(spark, raw.limit(5), "t_schema", loc, RAW)
    slim = T.StructType([RAW["year"], T.StructField("tot_benes", T.StringType())])
    assert writers.full_reload(spark, raw.limit(7), "t_schema", loc, slim) == 7
    assert spark.table("t_schema").schema == slim and spark.table("t_schema").count() == 7
    assert len(os.listdir(loc)) == 1


def test_default_checkpoint_picks_up_new_pages(spark, tmpdir_fresh):
    from enrolmart.streaming.landing import ingest_available

    src = os.path.join(tmpdir_fresh, "all")
    writers.land_pages(_landed(spark), src, page_size=500)
    pages = readers.landed_json(spark, src)
    landing, target = os.path.join(tmpdir_fresh, "landing"), os.path.join(tmpdir_fresh, "typed")
    pages.where(F.col("page_offset") < 1500).write.json(landing)
    first = ingest_available(spark, landing, target, max_files_per_trigger=1).count()
    assert first == 1500
    pages.where(F.col("page_offset") >= 1500).write.mode("append").json(landing)
    assert ingest_available(spark, landing, target).count() == pages.count()


@pytest.mark.parametrize("lost", [0, 1500, 3000, None])
def test_landing_must_be_complete(spark, tmpdir_fresh, lost):
    src, landing = os.path.join(tmpdir_fresh, "all"), os.path.join(tmpdir_fresh, "landing")
    writers.land_pages(_landed(spark), src, page_size=500)
    assert not [d for d in os.listdir(src) if d.startswith("page_offset=")]
    readers.require_complete(spark, src)
    total = readers.declared_total(spark, src)
    pages = readers.landed_json(spark, src)
    kept = pages if lost is None else pages.where(F.col("page_offset") != lost)
    kept.write.json(landing)
    gaps = [g.page_offset for g in readers.page_gaps(spark, landing, total).where("gap").collect()]
    assert gaps == ([] if lost is None else [min(lost + 500, total)])
    with pytest.raises(ValueError, match="declares no total"):
        readers.require_complete(spark, landing)
    spark.range(1).select(F.lit(total).alias("total")).write.json(os.path.join(landing, readers.TOTAL_DIR))
    if lost is None:
        readers.require_complete(spark, landing)
    else:
        with pytest.raises(ValueError, match="missing"):
            readers.require_complete(spark, landing)


def test_csv_cells_that_do_not_parse_are_missing(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "c.csv")
    with open(path, "w") as f:
        f.write("a,b,d\n1,2.5,2025-01-01\nx,*,2025-13-01\n3,,\n")
    from pyspark.sql import types as T

    schema = T._parse_datatype_string("a int, b double, d date")
    rows = readers.read_csv(spark, path, schema).collect()
    assert [(r.a, r.b) for r in rows] == [(1, 2.5), (None, None), (3, None)]
    assert [r.d is None for r in rows] == [False, True, True]


def test_new_files_are_seen(spark, tmpdir_fresh):
    for t in ("orders", "customer"):
        src = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        src.limit(100 if t == "orders" else 10**6).write.parquet(os.path.join(tmpdir_fresh, f"{t}.parquet"))
    count = lambda: release(spark, tmpdir_fresh).stg.count()
    before = count()
    more = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    more.write.mode("append").parquet(os.path.join(tmpdir_fresh, "orders.parquet"))
    assert count() > before


def test_scratch_is_cleared(spark):
    import __spark_entry__ as E

    from enrolmart import session

    known = len(session._SCRATCH)
    assert E.queries()["full_reload"](spark, SF_SMALL).count() > 0
    made = session._SCRATCH[known:]
    assert made and all(session.path_exists(spark, p) for p in made)
    session.clear_scratch(spark)
    assert not any(session.path_exists(spark, p) for p in made)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("enrolmart_")]

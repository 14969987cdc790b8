"""Snapshots survive a crash between any two steps; layouts need no shuffle and prune."""

import os
import re

import pytest
from pyspark.sql import functions as F

from enrolmart.plans.landing_queries import state_peaks
from enrolmart.plans.relations import release
from enrolmart.schemas import RAW
from enrolmart.session import create_text, list_dirs
from enrolmart.sources import layouts, snapshots, writers

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "r")
    release(spark, SF_SMALL).raw.write.parquet(path)
    return spark.read.schema(RAW).parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_publish_keep_replace_latest(spark, raw, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    n = raw.count()
    assert snapshots.publish(raw.limit(5), root, "2025-11") == 5
    assert snapshots.publish(raw, root, "2025-12") == n
    assert snapshots.publish(raw.limit(1), root, "2025-12") is None
    reader = snapshots.read(spark, root)  # a running reader keeps what it resolved
    assert snapshots.publish(raw.limit(2), root, "2025-12", force=True) == 2
    assert reader.count() == n
    assert snapshots.read(spark, root).count() == 2
    assert snapshots.read(spark, root, "2025-11").count() == 5
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root, "2024-01")
    # The folder of the replaced release goes once no kept manifest names it.
    assert snapshots.vacuum(spark, root, keep=2) == []
    assert len(snapshots.vacuum(spark, root, keep=1)) == 1
    assert len([d for d in list_dirs(spark, root) if d.startswith("data-")]) == 2
    assert snapshots.read(spark, root).count() == 2


class Crash(BaseException):
    pass


@pytest.mark.parametrize("step", ["write", "point", "created"])
def test_crash_leaves_the_old_release(spark, raw, tmp_path, monkeypatch, step):
    root = str(tmp_path / "s")
    snapshots.publish(raw.limit(3), root, "2025-12")

    def crash(*_):
        raise Crash

    def half(spark, path, text):
        create_text(spark, path, text[: len(text) // 2])
        raise Crash

    if step == "write":
        plain = snapshots.observed_write
        monkeypatch.setattr(snapshots, "observed_write", lambda df, path: (plain(df.limit(1), path), crash()))
    elif step == "point":
        monkeypatch.setattr(snapshots, "_point", crash)
    else:
        monkeypatch.setattr(snapshots, "create_text", half)
    with pytest.raises(Crash):
        snapshots.publish(raw, root, "2025-12", force=True)
    monkeypatch.undo()
    assert snapshots.read(spark, root).count() == 3
    # The next one goes on from there.
    assert snapshots.publish(raw.limit(4), root, "2025-12", force=True) == 4
    assert snapshots.read(spark, root).count() == 4
    assert snapshots.publish(raw.limit(2), root, "2026-01") == 2
    assert snapshots.read(spark, root).count() == 2


def test_two_writers_do_not_undo_each_other(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    snapshots.publish(raw.limit(1), root, "2025-10")
    plain, other = snapshots.create_text, []

    def late(spark, path, text):
        if not other:  # another writer points first
            other.append(1)
            snapshots.publish(raw.limit(2), root, "2025-11")
        return plain(spark, path, text)

    monkeypatch.setattr(snapshots, "create_text", late)
    snapshots.publish(raw.limit(3), root, "2025-12")
    assert [snapshots.read(spark, root, x).count() for x in ("2025-10", "2025-11", "2025-12")] == [1, 2, 3]


def test_failing_write_leaves_no_folder(spark, raw, tmp_path):
    root = str(tmp_path / "s")
    snapshots.publish(raw.limit(1), root, "2025-12")
    bad = raw.withColumn("tot_benes", F.expr("raise_error('no')").cast("double"))
    with pytest.raises(Exception, match="no"):
        snapshots.publish(bad, root, "2026-01")
    assert len([d for d in list_dirs(spark, root) if d.startswith("data-")]) == 1


def test_lake_keys(spark, raw, tmp_path):
    assert snapshots.lake_key("/x/raw/enrollment/2025-11/a.parquet") == "enrollment/2025-11/a.parquet"
    assert snapshots.lake_key("s3a://b/enrollment/2025-11") == "enrollment/2025-11"
    assert snapshots.lake_key("/x/other/a.parquet") == "enrollment/a.parquet"
    lake, source = str(tmp_path / "lake"), str(tmp_path / "in" / "file.parquet")
    with pytest.raises(FileNotFoundError):
        snapshots.lake_copy(spark, source, lake)
    raw.limit(4).write.parquet(source)
    target = snapshots.lake_copy(spark, source, lake)
    assert target == f"{lake}/enrollment/file.parquet"
    raw.limit(2).write.mode("overwrite").parquet(source)
    assert snapshots.lake_copy(spark, source, lake) == target
    assert snapshots.read(spark, target).count() == 4  # it was there
    snapshots.lake_copy(spark, source, lake, force=True)
    assert snapshots.read(spark, target).count() == 2
    assert snapshots.lake_copy(spark, source, lake, "k/x") == f"{lake}/k/x"


def test_full_reload_counts_without_a_second_job(spark, raw, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reload", "reload")
    try:
        assert writers.full_reload(spark, raw, "t_observed", str(tmp_path / "t"), RAW) == raw.count()
        spark.sparkContext.setJobGroup("written", "written")
        writers.observed_write(raw, str(tmp_path / "w"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sql("DROP TABLE IF EXISTS t_observed")
    assert len(tracker.getJobIdsForGroup("written")) == 1


def test_bucketed_tables_join_without_a_shuffle(spark, raw, tmp_path):
    tables = {"t_counties": "County", "t_states": "State"}
    for t, level in tables.items():
        layouts.bucketed_write(
            raw.where(F.col("bene_geo_lvl") == level), t, str(tmp_path / t), "bene_state_abrvtn", 4, ("year",)
        )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = state_peaks(spark.table("t_counties"), spark.table("t_states"))
        p = plan(df)
        assert "Exchange" not in p and "SortMergeJoin" in p
        want = state_peaks(*[raw.where(F.col("bene_geo_lvl") == x) for x in ("County", "State")])
        assert "Exchange hashpartitioning" in plan(want)
        assert df.exceptAll(want).isEmpty() and want.exceptAll(df).isEmpty() and not df.isEmpty()
        files = [f for f in os.listdir(tmp_path / "t_counties") if f.endswith(".parquet")]
        assert len(files) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for t in tables:
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_years_are_pruned_and_replaced_singly(spark, raw, tmp_path):
    path = str(tmp_path / "years")
    with pytest.raises(FileNotFoundError):
        layouts.latest_year(spark, path)
    layouts.write_years(raw, path)
    found = layouts.years(spark, path)
    assert found == sorted(int(r[0]) for r in raw.select("year").distinct().collect())
    latest = layouts.latest_year(spark, path)
    scan = latest._jdf.queryExecution().sparkPlan().toString()
    assert re.search(rf"PartitionFilters: \[.*year#\d+ = {found[-1]}", scan)
    assert {f.split("/")[-2] for f in latest.inputFiles()} <= {f"year={y}" for y in found}
    assert len({r[0] for r in latest.select(F.input_file_name()).distinct().collect() if f"year={found[-1]}" not in r[0]}) == 0
    before = raw.where(F.col("year") != str(found[0])).count()
    one = raw.where((F.col("year") == str(found[0])) & (F.col("bene_geo_lvl") == "National"))
    layouts.write_years(one, path)
    back = layouts.read_years(spark, path)
    assert back.where(F.col("year") != str(found[0])).count() == before
    assert back.where(F.col("year") == str(found[0])).count() == one.count() > 0
    assert back.select(*RAW.names).exceptAll(raw).isEmpty()

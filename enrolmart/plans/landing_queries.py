"""Queries of published landings, snapshots and stored layouts (registered on import).

Like the source and sink queries: each writes what Spark derives from the
driver's tables to a fresh folder and returns a lazy read of it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from enrolmart.operators import quality, sketches
from enrolmart.operators.marts import national
from enrolmart.operators.staging import typed_raw
from enrolmart.plans.io_queries import EARLIER, GAP_PAGE, LATEST, PAGE_SIZE, _PAGES, _table_name
from enrolmart.plans.oracle import with_chain
from enrolmart.plans.registry import MIN_RAW_ROWS, register
from enrolmart.plans.relations import release
from enrolmart.schemas import BY_STATE, DIMENSIONS, MEASURES, RAW
from enrolmart.session import scratch_dir, scratch_family
from enrolmart.sources import catalog, layouts, pages, readers, snapshots, writers

BUCKETS = 8
# What the broken inputs below leave of a record.
_CUT = "concat('{\"YEAR\":\"', year, '\",\"BENE_STATE_ABRVTN\":\"', bene_state_abrvtn)"
_CUT_ROWS = "bene_geo_lvl = 'State' AND month = 'Year'"


def _severity() -> dict[str, str]:
    return {c.upper(): "error" if c in DIMENSIONS else "warn" for c in DIMENSIONS + MEASURES}


# --- pages as published ------------------------------------------------------


@register("json_records_pages", with_chain("SELECT * FROM typed"))
def q_json_records_pages(spark, sf_dir):
    """Page files that hold arrays, checked for completeness, as the typed relation."""
    landing = scratch_dir(spark, "pages")
    pages.land_page_files(release(spark, sf_dir).landed, landing, PAGE_SIZE)
    pages.require_pages(spark, landing)
    return typed_raw(pages.page_records(spark, landing).drop(pages.BROKEN_COL, "page_offset", "file"))


_KEPT_PAGES = (
    _PAGES + ", total AS (SELECT sum(n_rows)::BIGINT AS n FROM pages), "
    "files AS (SELECT page_offset, CASE WHEN page_offset = {cut} THEN 0 ELSE n_rows END AS n_rows, page_offset = {cut} AS cut, false AS ends "
    "FROM pages WHERE page_offset NOT IN ({lost}) UNION ALL SELECT n, 0, false, true FROM total)"
)
_FAULTS = (
    "SELECT page_offset, n_rows, CASE WHEN cut THEN 'broken' WHEN page_offset <> 0 AND NOT EXISTS "
    "(SELECT 1 FROM files k WHERE k.n_rows > 0 AND k.page_offset + k.n_rows = f.page_offset) THEN 'gap' END AS fault, ends FROM files f"
)


@register("page_gaps_files", with_chain(_FAULTS, _KEPT_PAGES.format(cut=-1, lost=2 * GAP_PAGE)))
def q_page_gaps_files(spark, sf_dir):
    """Page files of which one is missing."""
    whole, landing = scratch_dir(spark, "pages"), scratch_dir(spark, "pages")
    pages.land_page_files(release(spark, sf_dir).landed, whole, GAP_PAGE)
    texts = spark.read.schema("value string, page_offset bigint").text(whole, wholetext=True)
    pages.write_pages(texts.where(F.col("page_offset") != 2 * GAP_PAGE), landing)
    return pages.page_faults(spark, landing)


@register("page_gaps_files_broken", with_chain(_FAULTS, _KEPT_PAGES.format(cut=GAP_PAGE, lost=0)))
def q_page_gaps_files_broken(spark, sf_dir):
    """Page files without the first one, and one that ends in the middle of a record."""
    whole, landing = scratch_dir(spark, "pages"), scratch_dir(spark, "pages")
    pages.land_page_files(release(spark, sf_dir).landed, whole, GAP_PAGE)
    texts = spark.read.schema("value string, page_offset bigint").text(whole, wholetext=True)
    cut = F.when(F.col("page_offset") == GAP_PAGE, F.expr("left(value, length(value) - 10)")).otherwise(F.col("value"))
    pages.write_pages(texts.where("page_offset != 0").withColumn("value", cut), landing)
    return pages.page_faults(spark, landing)


# --- broken records ----------------------------------------------------------


@register(
    "json_records_broken",
    with_chain(
        f"SELECT *, NULL AS broken_text, NULL AS severity FROM typed WHERE NOT ({_CUT_ROWS}) UNION ALL "
        f"SELECT {', '.join(f'NULL AS {c}' for c in DIMENSIONS + MEASURES)}, {_CUT}, 'error' FROM typed WHERE {_CUT_ROWS}"
    ),
)
def q_json_records_broken(spark, sf_dir):
    """Lines of which some are cut off: good rows, and the texts of the quarantine."""
    landing = scratch_dir(spark, "landing")
    landed = release(spark, sf_dir).landed
    record = F.to_json(F.struct(*[F.col(c).alias(c.upper()) for c in landed.columns]))
    lines = landed.select(F.when(F.expr(_CUT_ROWS), F.expr(_CUT)).otherwise(record).alias("value"))
    lines.write.text(landing)
    found = pages.quarantine(pages.line_records(spark, landing), scratch_dir(spark, "ingested"))
    good = typed_raw(found.good.drop("file"))
    broken = found.broken.select(pages.BROKEN_COL, F.lit("error").alias("severity"))
    return good.unionByName(broken, allowMissingColumns=True)


_CSV_ROWS = "state <> 'UK' AND year % 2 = 0"


@register(
    "csv_records_broken",
    with_chain(
        f"SELECT *, NULL AS broken_text, NULL AS severity FROM by_state WHERE NOT ({_CSV_ROWS}) UNION ALL "
        f"SELECT {', '.join(f'NULL AS {f.name}' for f in BY_STATE.fields)}, concat(year, ',', state), 'error' FROM by_state WHERE {_CSV_ROWS}"
    ),
)
def q_csv_records_broken(spark, sf_dir):
    """CSV lines of which some lack cells: good rows with their missing cells, and the quarantine."""
    export = scratch_dir(spark, "exports")
    mart = release(spark, sf_dir).by_state()
    line = F.to_csv(F.struct(*[F.col(f.name) for f in BY_STATE.fields]))
    cut = F.concat_ws(",", F.col("year").cast("string"), "state")
    mart.select(F.when(F.expr(_CSV_ROWS), cut).otherwise(line).alias("value")).write.text(export)
    found = pages.quarantine(
        pages.csv_records(spark, export, BY_STATE, header=False), scratch_dir(spark, "ingested")
    )
    broken = found.broken.select(pages.BROKEN_COL, F.lit("error").alias("severity"))
    return found.good.drop("file").unionByName(broken, allowMissingColumns=True)


# --- schema drift ------------------------------------------------------------

_ABSENT, _NULLED, _NEW = "aged_esrd_benes", "bene_fips_cd", "NEW_FLAG"


def _drift_sql(absent: str, nulled: str, new: str) -> str:
    told = [f"SELECT 'landed.schema_drift' AS check, '{absent.upper()}' AS column_name, 'absent' AS drift, 'warn' AS severity"] * bool(absent)
    told += [f"SELECT 'landed.schema_drift', '{new}', 'unexpected', 'warn'"] * bool(new)
    told += [
        f"SELECT 'landed.schema_drift' AS check, '{c.upper()}' AS column_name, 'always_null' AS drift, 'warn' AS severity "
        f"FROM landed HAVING count({'NULL' if c == nulled else c}) = 0"
        for c in DIMENSIONS + MEASURES
        if c != absent
    ]
    return with_chain(" UNION ALL ".join(told))


def _drifted(spark, sf_dir, page_files: bool):
    landing = scratch_dir(spark, "landing")
    landed = release(spark, sf_dir).landed
    rows = landed.drop(_ABSENT).withColumn(_NULLED, F.lit(None).cast("string")).withColumn(_NEW, F.lit("1"))
    if page_files:
        pages.land_page_files(rows, landing, PAGE_SIZE)
    else:
        rows.toDF(*[c.upper() for c in rows.columns]).write.option("ignoreNullFields", False).json(landing)
    return pages.schema_drift(pages.record_texts(spark, landing, page_files), "landed", _severity())


@register("dq_schema_drift", _drift_sql(_ABSENT, _NULLED, _NEW))
def q_dq_schema_drift(spark, sf_dir):
    """Lines with an absent, an always null and an unexpected field."""
    return _drifted(spark, sf_dir, False)


@register("dq_schema_drift_pages", _drift_sql(_ABSENT, _NULLED, _NEW))
def q_dq_schema_drift_pages(spark, sf_dir):
    """The same of page files."""
    return _drifted(spark, sf_dir, True)


# --- snapshots and lake keys -------------------------------------------------


@register("snapshot_release", with_chain("SELECT * FROM typed"))
def q_snapshot_release(spark, sf_dir):
    """Two releases behind one manifest, one of them replaced; the latest is read."""
    root, raw = scratch_dir(spark, "snapshots"), release(spark, sf_dir).raw
    snapshots.publish(raw.where(F.col("bene_geo_lvl") != "County"), root, EARLIER)
    snapshots.publish(raw.where(F.col("bene_geo_lvl") == "National"), root, LATEST)
    if snapshots.publish(raw, root, LATEST) is not None:
        raise RuntimeError("a release that is there was written again")
    snapshots.publish(raw, root, LATEST, force=True)
    return snapshots.read(spark, root)


@register("lake_copy", with_chain("SELECT * FROM typed"))
def q_lake_copy(spark, sf_dir):
    """A written release copied to the lake key that mirrors its path."""
    source, lake = f"{scratch_dir(spark, 'raw')}/enrollment/{LATEST}", scratch_dir(spark, "lake")
    writers.observed_write(release(spark, sf_dir).raw, source)
    target = snapshots.lake_copy(spark, source, lake)
    if target != f"{lake}/enrollment/{LATEST}":
        raise RuntimeError(f"copied to {target}")
    return snapshots.read(spark, target)


# --- counts of the writing jobs ----------------------------------------------


def _observed_sql(loaded: str) -> str:
    return with_chain(
        "SELECT 'raw_load.observed_parity' AS check, l AS observed_rows, s - l AS failed_rows FROM n UNION ALL "
        f"SELECT 'raw_load.observed_min_rows_{MIN_RAW_ROWS}', l, CAST(l < {MIN_RAW_ROWS} AS BIGINT) FROM n",
        f"n AS (SELECT count(*) AS s, count_if({loaded}) AS l FROM typed)",
    )


def _observed(spark, sf_dir, keep):
    root, table = scratch_dir(spark, "snapshots"), _table_name("raw")
    written = snapshots.publish(release(spark, sf_dir).raw, root, LATEST)
    stored = keep(snapshots.read(spark, root))
    loaded = writers.full_reload(spark, stored, table, scratch_dir(spark, "table"), RAW)
    return quality.observed_load(spark, "raw_load", written, loaded, MIN_RAW_ROWS)


@register("dq_load_observed", _observed_sql("true"))
def q_dq_load_observed(spark, sf_dir):
    """A release and the table loaded from it, by the counts that both writes took."""
    return _observed(spark, sf_dir, lambda df: df)


@register("dq_load_observed_broken", _observed_sql("bene_geo_lvl <> 'County'"))
def q_dq_load_observed_broken(spark, sf_dir):
    """A load that lost the county rows."""
    return _observed(spark, sf_dir, lambda df: df.where("bene_geo_lvl <> 'County'"))


# --- stored layouts ----------------------------------------------------------


@register(
    "bucketed_join",
    with_chain(
        "SELECT c.year, c.month, c.bene_state_abrvtn, c.bene_county_desc, c.tot_benes, s.state_peak, s.state_rows "
        "FROM typed c JOIN (SELECT bene_state_abrvtn, max(tot_benes) AS state_peak, count(*) AS state_rows FROM typed "
        "WHERE bene_geo_lvl = 'State' GROUP BY bene_state_abrvtn) s USING (bene_state_abrvtn) WHERE c.bene_geo_lvl = 'County'"
    ),
)
def q_bucketed_join(spark, sf_dir):
    """County rows with their state's peak, joined and grouped on the bucketed state."""
    raw = release(spark, sf_dir).raw
    counties, states = _table_name("counties"), _table_name("states")
    for table, level in ((counties, "County"), (states, "State")):
        layouts.bucketed_write(
            raw.where(F.col("bene_geo_lvl") == level), table, scratch_dir(spark, "bucketed"), "bene_state_abrvtn", BUCKETS, ("year", "month")
        )
    return state_peaks(spark.table(counties), spark.table(states))


def state_peaks(counties, states):
    """Each county row with the peak and the number of its state's rows."""
    peaks = states.groupBy("bene_state_abrvtn").agg(
        F.max("tot_benes").alias("state_peak"), F.count(F.lit(1)).alias("state_rows")
    )
    return counties.join(peaks, "bene_state_abrvtn").select(
        "year", "month", "bene_state_abrvtn", "bene_county_desc", "tot_benes", "state_peak", "state_rows"
    )


@register(
    "year_reload",
    with_chain(
        "SELECT * FROM typed WHERE year <> (SELECT max(year) FROM typed) OR bene_geo_lvl <> 'County'"
    ),
)
def q_year_reload(spark, sf_dir):
    """The latest year replaced by rows without counties; all other years stay."""
    path, raw = scratch_dir(spark, "years"), release(spark, sf_dir).raw
    layouts.write_years(raw, path)
    latest = layouts.latest_year(spark, path)
    again = scratch_dir(spark, "again")
    writers.observed_write(latest.where("bene_geo_lvl <> 'County'"), again)
    layouts.write_years(readers.scan_release(spark, again), path)
    return layouts.read_years(spark, path).select(*[f.name for f in RAW.fields])


@register("year_slice_stored", with_chain("SELECT * FROM typed WHERE year = (SELECT max(year) FROM typed)"))
def q_year_slice_stored(spark, sf_dir):
    """The latest year of a stored release, by the listing and one folder."""
    path = scratch_dir(spark, "years")
    layouts.write_years(release(spark, sf_dir).raw, path)
    return layouts.latest_year(spark, path).select(*[f.name for f in RAW.fields])


# --- stored sketches, catalog views ------------------------------------------

_SKETCHED = ("bene_state_abrvtn", "bene_county_desc", "month", "tot_benes", "aged_tot_benes")


@register(
    "distinct_sketches",
    with_chain(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within_bound FROM typed" for c in _SKETCHED
        )
    ),
)
def q_distinct_sketches(spark, sf_dir):
    """Distinct counts of two stored releases from their merged sketches, beside the exact ones."""
    root, raw = scratch_dir(spark, "sketched"), release(spark, sf_dir).raw
    parts = {EARLIER: raw.where("month = 'Year'"), LATEST: raw.where("month <> 'Year' OR month IS NULL")}
    for label, rows in parts.items():
        snapshots.publish(rows, root, label)
        sketches.write_sketches(snapshots.read(spark, root, label), root, label, list(_SKETCHED))
    estimates = sketches.distinct_estimates(spark, root, list(parts))
    both = snapshots.read(spark, root, EARLIER).unionByName(snapshots.read(spark, root, LATEST))
    exact = both.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).unpivot([], list(_SKETCHED), "column_name", "exact")
    off = F.abs(F.col("estimate") - F.col("exact"))
    return exact.join(estimates, "column_name").select(
        "column_name", "exact", (off <= F.col("exact") * sketches.error_bound() + 1).alias("within_bound")
    )


@register("catalog_view_national", with_chain("SELECT * FROM national"))
def q_catalog_view_national(spark, sf_dir):
    """The national mart over a staging view that the catalog keeps."""
    raw = release(spark, sf_dir).raw
    names = catalog.create_views(spark, raw, _view_name(), scratch_dir(spark, "table"))
    return national(spark.table(names["stg"]))


def _view_name() -> str:
    """A name whose views and table ``clear_scratch`` drops."""
    return scratch_family("catalog", {"raw": "table", "stg": "view", "monthly": "view", "annual": "view"})

"""Source and sink queries (registered on import).

Each query writes the release derived from the driver's tables to a fresh
folder under the shared checkpoint root, then returns a lazy read of what
was written, so the oracle is the SQL of the relation that went in.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.operators import quality
from enrolmart.plans.oracle import with_chain
from enrolmart.plans.registry import register
from enrolmart.plans.relations import register_views, release
from enrolmart.schemas import BY_STATE, DIMENSIONS, MEASURES, NATIONAL, RAW, RAW_KEY, STG_MEASURES
from enrolmart.session import note_views, scratch_dir, scratch_name
from enrolmart.sources import readers, writers
from enrolmart.streaming.landing import ingest_available

LATEST = "2025-12"
EARLIER = "2025-11"
PAGE_SIZE = 5000


def _table_name(label: str) -> str:
    return scratch_name("table", label)


def _expect(done: bool, wanted: bool, what: str) -> None:
    if done is not wanted:
        raise RuntimeError(f"{what}: {'not ' * wanted}written")


@register("scan_release", with_chain("SELECT * FROM typed"))
def q_scan_release(spark, sf_dir):
    root = scratch_dir(spark, "enrollment")
    writers.write_release(release(spark, sf_dir).raw, root, LATEST)
    return readers.scan_release(spark, writers.release_path(root, LATEST))


@register("latest_release", with_chain(f"SELECT *, '{LATEST}' AS release FROM typed"))
def q_latest_release(spark, sf_dir):
    root = scratch_dir(spark, "enrollment")
    raw = release(spark, sf_dir).raw
    # An earlier, smaller snapshot next to the full one.
    writers.write_release(raw.where(F.col("bene_geo_lvl") != "County"), root, EARLIER)
    writers.write_release(raw, root, LATEST)
    return readers.latest_release(spark, root)


@register("json_records", with_chain("SELECT * FROM typed"))
def q_json_records(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    writers.land_pages(release(spark, sf_dir).landed, landing, PAGE_SIZE)
    return readers.read_landing(spark, landing)


@register("json_records_incremental", with_chain("SELECT * FROM typed"))
def q_json_records_incremental(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    writers.land_pages(release(spark, sf_dir).landed, landing, PAGE_SIZE)
    return ingest_available(spark, landing, scratch_dir(spark, "ingested"))


_KEY = ", ".join(RAW_KEY)


GAP_PAGE = 200
_PAGES = (
    "pages AS (SELECT page_offset, count(*) AS n_rows FROM ("
    f"SELECT CAST((row_number() OVER (ORDER BY {_KEY}) - 1) // {GAP_PAGE} * {GAP_PAGE} AS BIGINT) AS page_offset "
    "FROM landed) GROUP BY page_offset)"
)
_GAPS = (
    "SELECT page_offset, n_rows, page_offset <> 0 AND NOT EXISTS "
    "(SELECT 1 FROM kept k WHERE k.page_offset + k.n_rows = p.page_offset) AS gap FROM "
    "(SELECT * FROM kept UNION ALL SELECT (SELECT sum(n_rows)::BIGINT FROM pages), 0) p"
)


@register("page_gaps", with_chain(_GAPS, _PAGES + ", kept AS (SELECT * FROM pages)"))
def q_page_gaps(spark, sf_dir):
    """A whole landing: every page, and the declared end, follows another page."""
    landing = scratch_dir(spark, "landing")
    writers.land_pages(release(spark, sf_dir).landed, landing, GAP_PAGE)
    return readers.page_gaps(spark, landing, readers.declared_total(spark, landing))


@register(
    "page_gaps_broken",
    with_chain(
        _GAPS,
        _PAGES + f", kept AS (SELECT * FROM pages WHERE page_offset NOT IN (0, {3 * GAP_PAGE}, (SELECT max(page_offset) FROM pages)))",
    ),
)
def q_page_gaps_broken(spark, sf_dir):
    """A landing that lost its first, a middle and its last page."""
    whole, landing = scratch_dir(spark, "landing"), scratch_dir(spark, "landing")
    writers.land_pages(release(spark, sf_dir).landed, whole, GAP_PAGE)
    total = readers.declared_total(spark, whole)
    last = (total - 1) // GAP_PAGE * GAP_PAGE
    pages = readers.landed_json(spark, whole)
    pages.where(~F.col("page_offset").isin(0, 3 * GAP_PAGE, last)).write.json(landing)
    return readers.page_gaps(spark, landing, total)


@register(
    "dq_missing_columns",
    with_chain(
        " UNION ALL ".join(
            f"SELECT 'landed.required_columns' AS check, '{c.upper()}' AS column_name, "
            f"'{'error' if c in DIMENSIONS else 'warn'}' AS severity FROM landed HAVING count({c}) = 0"
            for c in DIMENSIONS + MEASURES
        )
    ),
)
def q_dq_missing_columns(spark, sf_dir):
    """Columns absent from every landed record: dimensions are errors, measures warnings."""
    landing = scratch_dir(spark, "landing")
    writers.land_pages(release(spark, sf_dir).landed, landing, PAGE_SIZE)
    landed = readers.landed_json(spark, landing)
    return quality.union_checks(
        [
            readers.empty_columns(landed, "landed", [c.upper() for c in DIMENSIONS], "error"),
            readers.empty_columns(landed, "landed", [c.upper() for c in MEASURES], "warn"),
        ]
    )


@register("csv_roundtrip_by_state", with_chain("SELECT * FROM by_state"))
def q_csv_roundtrip_by_state(spark, sf_dir):
    rel = release(spark, sf_dir)
    paths = writers.export_marts(rel.national(), rel.by_state(), scratch_dir(spark, "exports"))
    return readers.read_csv(spark, paths["by_state"], BY_STATE)


@register("csv_roundtrip", with_chain("SELECT * FROM national"))
def q_csv_roundtrip(spark, sf_dir):
    rel = release(spark, sf_dir)
    paths = writers.export_marts(rel.national(), rel.by_state(), scratch_dir(spark, "exports"))
    return readers.read_csv(spark, paths["national"], NATIONAL)


@register("table_scan", with_chain("SELECT * FROM national"))
def q_table_scan(spark, sf_dir):
    prefix = scratch_name("view", "q") + "_"
    names = register_views(spark, release(spark, sf_dir), prefix)
    note_views(names.values())
    return readers.table_scan(spark, f"SELECT * FROM {names['national']}")


@register("parquet_roundtrip", with_chain(f"SELECT *, '{LATEST}' AS release FROM typed"))
def q_parquet_roundtrip(spark, sf_dir):
    lake = scratch_dir(spark, "lake")
    writers.write_lake(release(spark, sf_dir).raw, lake, LATEST)
    return spark.read.schema(T.StructType(RAW.fields + [T.StructField("release", T.StringType())])).parquet(lake)


@register("skip_if_exists", with_chain("SELECT * FROM typed"))
def q_skip_if_exists(spark, sf_dir):
    root = scratch_dir(spark, "enrollment")
    raw = release(spark, sf_dir).raw
    _expect(writers.write_release(raw, root, LATEST), True, "first release")
    # Same release again without force: kept as it was.
    again = writers.write_release(raw.where(F.col("bene_geo_lvl") == "National"), root, LATEST)
    _expect(again, False, "existing release")
    return readers.scan_release(spark, writers.release_path(root, LATEST))


@register("full_reload", with_chain("SELECT * FROM typed"))
def q_full_reload(spark, sf_dir):
    raw = release(spark, sf_dir).raw
    table = _table_name("raw")
    location = scratch_dir(spark, "table")
    # A first load of a partial snapshot, then the full one: replaced, not appended.
    writers.full_reload(spark, raw.where(F.col("bene_geo_lvl") == "National"), table, location, RAW)
    writers.full_reload(spark, raw, table, location, RAW)
    return spark.table(table)


@register("load_if_empty", with_chain("SELECT * FROM typed"))
def q_load_if_empty(spark, sf_dir):
    raw = release(spark, sf_dir).raw
    table = _table_name("raw")
    location = scratch_dir(spark, "table")
    _expect(writers.load_if_empty(spark, raw, table, location, RAW), True, "empty table")
    part = raw.where(F.col("bene_geo_lvl") == "National")
    _expect(writers.load_if_empty(spark, part, table, location, RAW), False, "loaded table")
    return spark.table(table)


@register("clustered_write", with_chain("SELECT * FROM typed"))
def q_clustered_write(spark, sf_dir):
    path = scratch_dir(spark, "clustered")
    writers.clustered_write(release(spark, sf_dir).raw, path)
    return readers.scan_release(spark, path)


def _legacy_sql() -> str:
    cols = ["report_date"]
    cols += [f"NULLIF({m}, 0) AS {m}" for m in STG_MEASURES]
    cols += ["ma_penetration_rate", "ffs_penetration_rate", "year", "NULLIF(month, '') AS month"]
    return "SELECT " + ", ".join(cols) + " FROM national"


@register("export_legacy_nulls", with_chain(_legacy_sql()))
def q_export_legacy_nulls(spark, sf_dir):
    return writers.legacy_nulls(release(spark, sf_dir).national())


@register(
    "dq_row_parity",
    with_chain(
        "SELECT 'raw_load.row_parity' AS check, CAST(abs("
        "(SELECT count(*) FROM typed) - (SELECT sum(n) FROM (SELECT count(*) AS n FROM landed "
        "GROUP BY bene_geo_lvl, bene_state_abrvtn, bene_county_desc))) AS BIGINT) AS failed_rows"
    ),
)
def q_dq_row_parity(spark, sf_dir):
    """A written release against the table loaded from it (both counts read stored rows)."""
    root, table = scratch_dir(spark, "enrollment"), _table_name("raw")
    writers.write_release(release(spark, sf_dir).raw, root, LATEST)
    stored = readers.scan_release(spark, writers.release_path(root, LATEST))
    writers.full_reload(spark, stored, table, scratch_dir(spark, "table"), RAW)
    return quality.row_parity(stored, spark.table(table), "raw_load")


@register(
    "dq_row_parity_broken",
    with_chain(
        "SELECT 'raw_load.row_parity' AS check, count(*) AS failed_rows FROM typed WHERE bene_geo_lvl = 'County'"
    ),
)
def q_dq_row_parity_broken(spark, sf_dir):
    """A load that lost the county rows."""
    root, table = scratch_dir(spark, "enrollment"), _table_name("raw")
    writers.write_release(release(spark, sf_dir).raw, root, LATEST)
    stored = readers.scan_release(spark, writers.release_path(root, LATEST))
    lost = stored.where(F.col("bene_geo_lvl") != "County")
    writers.full_reload(spark, lost, table, scratch_dir(spark, "table"), RAW)
    return quality.row_parity(stored, spark.table(table), "raw_load")


@register("mart_reload_national", with_chain("SELECT * FROM national"))
def q_mart_reload(spark, sf_dir):
    """Materialize the national mart as a table (model materialization), read it back."""
    rel = release(spark, sf_dir)
    table = _table_name("national")
    writers.full_reload(spark, rel.national(), table, scratch_dir(spark, "table"), NATIONAL)
    return spark.table(table)

"""Sinks and load strategies: release Parquet, lake copy, full reload, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.operators.ordering import with_position
from enrolmart.schemas import RAW_KEY
from enrolmart.session import move, path_exists, remove
from enrolmart.sources.readers import PAGE_COL, RELEASE_COL, TOTAL_DIR


def release_path(root: str, release: str) -> str:
    return f"{root.rstrip('/')}/{RELEASE_COL}={release}"


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write of the folder was committed (Spark's success marker is there)."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_release(df: DataFrame, root: str, release: str, force: bool = False) -> bool:
    """Write one release as snappy Parquet; keep a completed release unless ``force``.

    The data go to a hidden folder next to the release and are renamed into
    place once committed, so a failing write leaves the old release as it
    was and a crashed one never counts as existing.  Returns True when data
    was written.
    """
    spark, path = df.sparkSession, release_path(root, release)
    if is_complete(spark, path) and not force:
        return False
    new = f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex[:12]}"
    try:
        df.write.option("compression", "snappy").parquet(new)
    except Exception:
        remove(spark, new)
        raise
    old = f"{root.rstrip('/')}/_replaced-{uuid.uuid4().hex[:12]}"
    if path_exists(spark, path):
        move(spark, path, old)
    move(spark, new, path)
    remove(spark, old)
    return True


def write_lake(df: DataFrame, root: str, release: str, force: bool = False) -> bool:
    """Copy a release into a lake dataset partitioned by ``release`` (its folder only)."""
    return write_release(df, root, release, force)


def land_pages(
    landed: DataFrame, path: str, page_size: int = 5000, order: list[Column] | None = None
) -> None:
    """Land a release as JSON pages of ``page_size`` records, as published.

    Records keep string values and upper-case names; each carries its page's
    ``page_offset``.  Page membership comes from a distributed global
    position in key order, so pages are deterministic.  Files follow the
    ranges of that order and not the pages, whose number grows with the data.
    The declared total is written next to them, like the empty page that
    ends a download.
    """
    order = order or [F.col(c).asc_nulls_last() for c in RAW_KEY]
    numbered = with_position(landed, order, "_pos")
    paged = numbered.withColumn(
        PAGE_COL, (F.floor((F.col("_pos") - 1) / page_size) * page_size).cast("bigint")
    ).drop("_pos")
    paged = paged.toDF(*[c if c == PAGE_COL else c.upper() for c in paged.columns])
    paged.write.mode("overwrite").json(path)
    spark = landed.sparkSession
    total = spark.read.schema(f"{PAGE_COL} long").json(path).agg(F.count(F.lit(1)).alias("total"))
    total.write.mode("overwrite").json(f"{path.rstrip('/')}/{TOTAL_DIR}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def observed_write(df: DataFrame, path: str) -> int:
    """Write snappy Parquet; the number of rows, counted by the writing job itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy").parquet(path)
    return seen.get["rows"]


def full_reload(spark: SparkSession, df: DataFrame, table: str, location: str, schema: T.StructType) -> int:
    """Create the table if missing, else replace its contents (and a changed schema).

    The rows are written to a new folder under ``location`` and counted on
    the way; only then does the table point to it, and the folder it pointed to
    is removed.  A load that fails on the way leaves the table as it was.
    Returns the loaded row count.
    """
    new = f"{location.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    try:
        count = observed_write(rows, new)
    except Exception:
        remove(spark, new)
        raise
    old = None
    if spark.catalog.tableExists(table):
        told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
        old = told.get("Location")
        same = [(f.name, f.dataType) for f in spark.table(table).schema.fields] == [
            (f.name, f.dataType) for f in schema.fields
        ]
        if same:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE {table}")  # an external table: its files stay until below
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet LOCATION '{new}'")
    if old:
        remove(spark, old)
    return count


def load_if_empty(
    spark: SparkSession, df: DataFrame, table: str, location: str, schema: T.StructType, force: bool = False
) -> bool:
    """Load only when the table is missing or empty (or ``force``).

    ``isEmpty`` stops at the first row found.  Returns True when loaded.
    """
    if not force and spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
        return False
    full_reload(spark, df, table, location, schema)
    return True


def clustered_write(df: DataFrame, path: str, n_files: int | None = None) -> None:
    """Co-locate rows by state and sort them by (year, month, state) within files.

    Range partitioning on (state, year, month, level, county) keeps a state's
    rows in adjacent files while splitting a hot state over several tasks;
    the in-file sort gives row-group statistics on year and month, so
    filtered scans skip row groups.  There are ``n_files`` files, else as
    many as ``spark.sql.shuffle.partitions``.
    """
    n = n_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(
            n, "bene_state_abrvtn", "year", "month", "bene_geo_lvl", "bene_county_desc"
        )
        .sortWithinPartitions("year", "month", "bene_state_abrvtn")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Ordered CSV export with header as a single file (marts only: one row per
    month or per state-year, so the one writer task is bounded)."""
    (
        df.orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )


# The two fixed exports: (folder, mart, order).
EXPORTS = (
    ("national", "national", ("report_date",)),
    ("by_state", "by_state", ("year", "state")),
)


def export_marts(national: DataFrame, by_state: DataFrame, root: str) -> dict[str, str]:
    """Write both mart exports under ``root``; returns mart -> folder."""
    marts = {"national": national, "by_state": by_state}
    out = {}
    for folder, mart, order in EXPORTS:
        path = f"{root.rstrip('/')}/{folder}"
        export_csv(marts[mart], path, list(order))
        out[mart] = path
    return out


def legacy_nulls(df: DataFrame) -> DataFrame:
    """Export quirk, opt-in: doubles equal to 0.0 and empty strings become NULL.

    Integers (e.g. year), dates and decimals pass unchanged.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.nullif(c, F.lit(0.0))
        elif isinstance(f.dataType, T.StringType):
            c = F.nullif(c, F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)

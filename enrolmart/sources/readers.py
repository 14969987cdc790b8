"""Scans: release Parquet, latest release, landed JSON pages, CSV exports, SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.operators.profile import sql_str, stack_sql
from enrolmart.operators.staging import typed_raw
from enrolmart.schemas import LANDED, RAW
from enrolmart.session import list_dirs, path_exists

RELEASE_COL = "release"
PAGE_COL = "page_offset"
# The declared number of records of a landing (hidden from scans of the pages).
TOTAL_DIR = "_total"
_RELEASE = re.compile(rf"{RELEASE_COL}=([0-9]{{4}}-(?:0[1-9]|1[0-2]))")


def scan_release(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """Read one release folder with the fixed schema (no inference)."""
    return spark.read.schema(schema).parquet(path)


def releases(spark: SparkSession, root: str) -> list[str]:
    """Labels of the completed releases under ``root``, sorted.

    A release is a folder ``release=YYYY-MM`` with Spark's success marker;
    other labels and writes that crashed don't count.
    """
    found = (_RELEASE.fullmatch(d) for d in list_dirs(spark, root))
    return sorted(
        m[1] for m in found if m and path_exists(spark, f"{root.rstrip('/')}/{m[0]}/_SUCCESS")
    )


def latest_release(spark: SparkSession, root: str, schema: T.StructType = RAW) -> DataFrame:
    """Rows of the highest completed ``YYYY-MM`` release; error when there is none.

    The release list comes from the folder listing (metadata only); the read
    then filters on the partition column, so only that folder is scanned.
    """
    found = releases(spark, root)
    if not found:
        raise FileNotFoundError(f"No completed release found under {root}")
    latest = found[-1]
    full = T.StructType(schema.fields + [T.StructField(RELEASE_COL, T.StringType(), True)])
    return spark.read.schema(full).parquet(root).where(F.col(RELEASE_COL) == latest)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages (all values strings) -> typed raw relation.

    One multi-file scan over every page; an explicit all-string schema, so a
    value never changes type between pages.  Column names are lower-cased
    and measures coerced in one projection.
    """
    return typed_raw(spark.read.schema(LANDED).json(path))


def landed_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON pages as published (upper-case names, strings), plus page offset."""
    schema = T.StructType(LANDED.fields + [T.StructField(PAGE_COL, T.LongType(), True)])
    return spark.read.schema(schema).json(path)


def empty_columns(landed: DataFrame, relation: str, columns, severity: str) -> DataFrame:
    """Expected columns with no value in any record (schema drift in landed data).

    One aggregate pass: ``count(c) = 0`` means the field never appeared.
    Returns (check, column_name, severity), one row per absent column.
    """
    cols = list(columns)
    wide = landed.selectExpr(*[f"count(`{c}`) AS _{i}" for i, c in enumerate(cols)])
    long = wide.selectExpr(
        stack_sql([(sql_str(c), f"_{i}") for i, c in enumerate(cols)], ["column_name", "_n"])
    )
    return long.where(F.col("_n") == 0).select(
        F.lit(f"{relation}.required_columns").alias("check"),
        "column_name",
        F.lit(severity).alias("severity"),
    )


def page_gaps(spark: SparkSession, path: str, total: int | None = None) -> DataFrame:
    """Per landed page: (page_offset, n_rows, gap).

    A page has a gap before it unless it is the first (offset 0) or some
    page ends at its offset.  With a declared ``total`` the empty page that
    ends the download is checked the same way, so missing last pages show as
    well.  Rows are counted per page (partial aggregation) and the ends
    joined to the offsets; no task sees all pages.
    """
    pages = landed_json(spark, path).groupBy(PAGE_COL).agg(F.count(F.lit(1)).alias("n_rows"))
    ends = pages.select((F.col(PAGE_COL) + F.col("n_rows")).alias("_end")).distinct()
    if total is not None:
        last = spark.range(1).select(
            F.lit(total).cast("bigint").alias(PAGE_COL), F.lit(0).cast("bigint").alias("n_rows")
        )
        pages = pages.unionByName(last)
    return pages.join(ends, F.col(PAGE_COL) == F.col("_end"), "left").select(
        PAGE_COL, "n_rows", (F.col("_end").isNull() & (F.col(PAGE_COL) != 0)).alias("gap")
    )


def declared_total(spark: SparkSession, path: str) -> int:
    """The number of records that a landing says it has; an error when it says nothing."""
    where = f"{path.rstrip('/')}/{TOTAL_DIR}"
    if not path_exists(spark, where):
        raise ValueError(f"{path} declares no total: its download did not end")
    return spark.read.schema("total long").json(where).first()[0]


def require_complete(spark: SparkSession, path: str) -> None:
    """Raise when the landing under ``path`` misses its first, a middle or its last pages."""
    gaps = page_gaps(spark, path, declared_total(spark, path)).where("gap")
    missing = [r[PAGE_COL] for r in gaps.orderBy(PAGE_COL).limit(10).collect()]
    if missing:
        raise ValueError(f"pages missing before offsets {missing} of {path}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema; a cell that does not parse becomes NULL, its row is kept."""
    text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    cells = spark.read.schema(text).option("header", True).csv(path)
    return cells.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def table_scan(spark: SparkSession, sql_text: str) -> DataFrame:
    """Ad-hoc SQL over registered views or catalog tables."""
    return spark.sql(sql_text)

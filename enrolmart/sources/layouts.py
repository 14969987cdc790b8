"""Stored layouts: tables bucketed by a key, folders partitioned by year."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.schemas import RAW
from enrolmart.session import list_dirs

_YEAR = re.compile(r"year=([0-9]+)")


def bucketed_write(df: DataFrame, table: str, location: str, by: str, buckets: int, sort: tuple[str, ...] = ()) -> None:
    """Replace ``table`` with the rows hashed into ``buckets`` files by ``by`` and sorted within.

    Tables with the same key and number of buckets join and group on it
    without a shuffle.  Rows are dealt to the buckets before the write, so a
    bucket is one file.  A key that holds much of the table makes its bucket
    large: choose a finer key there.
    """
    (
        df.repartition(buckets, by)
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, by)
        .sortBy(by, *sort)
        .option("compression", "snappy")
        .option("path", location)
        .saveAsTable(table)
    )


def write_years(df: DataFrame, path: str) -> None:
    """Write the rows into one folder per year, replacing the years they hold and no other.

    Ranges over finer columns spread a year over several tasks, each of which
    writes to few folders.
    """
    fine = [c for c in ("month", "bene_state_abrvtn", "bene_county_desc") if c in df.columns]
    (
        df.repartitionByRange("year", *fine)
        .sortWithinPartitions("year", *fine)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year")
        .parquet(path)
    )


def years(spark: SparkSession, path: str) -> list[int]:
    """The years that are there, from the listing alone."""
    return sorted(int(m[1]) for d in list_dirs(spark, path) if (m := _YEAR.fullmatch(d)))


def read_years(
    spark: SparkSession, path: str, year: int | None = None, schema: T.StructType = RAW
) -> DataFrame:
    """All years, or one of them: then only its folder is read."""
    rows = spark.read.schema(schema).parquet(path)
    return rows if year is None else rows.where(F.col("year") == F.lit(year).cast(schema["year"].dataType))


def latest_year(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """The rows of the highest year; the listing tells it, no row is read for it."""
    found = years(spark, path)
    if not found:
        raise FileNotFoundError(f"no year under {path}")
    return read_years(spark, path, found[-1], schema)

"""Distinct counts from sketches that are stored with each release.

A release's sketches (one HyperLogLog sketch per column, a few KB) are made in
one scan when it is written.  The distinct counts of any set of releases come
from merging their sketches: a new month costs a scan of that month alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# log2 of a sketch's buckets: 4,096 of them, 1.6 % standard error.
LG_K = 12


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error within which an estimate lies, at this many standard deviations."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def sketches(df: DataFrame, columns: list[str], lg_k: int = LG_K) -> DataFrame:
    """(column_name, sketch): NULLs are not counted; one scan with map-side merging."""
    wide = df.agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    pairs = ", ".join(f"'{c}', _{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, sketch)")


def sketch_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/_sketches/label={label}"


def write_sketches(df: DataFrame, root: str, label: str, columns: list[str], lg_k: int = LG_K) -> None:
    """Store a release's sketches beside it, replacing older ones of the same label."""
    sketches(df, columns, lg_k).coalesce(1).write.mode("overwrite").parquet(sketch_path(root, label))


def distinct_estimates(spark: SparkSession, root: str, labels: list[str]) -> DataFrame:
    """(column_name, estimate) over the releases of these labels, from their sketches alone."""
    stored = spark.read.schema("column_name string, sketch binary").parquet(*[sketch_path(root, x) for x in labels])
    merged = stored.groupBy("column_name").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column_name", F.hll_sketch_estimate("sketch").alias("estimate"))

"""Declarative data-quality checks.

Each check returns rows ``(check, failed_rows)``; zero means pass.  Checks
on one relation share one aggregate pass (not-null, lengths); key checks
need one shuffle each.  Failure counts follow the usual data-test
conventions: not_null counts NULL rows, unique / combination counts
duplicated keys (NULL values ignored by unique, grouped by combination),
accepted_values counts distinct offending values (NULL ignored).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.operators.profile import sql_str, stack_sql

def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null(df: DataFrame, relation: str, cols: list[str]) -> DataFrame:
    """One row per column: number of NULL values.  One aggregate pass."""
    wide = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS _{i}" for i, c in enumerate(cols)])
    return wide.selectExpr(
        stack_sql(
            [(sql_str(f"{relation}.{c}.not_null"), f"_{i}") for i, c in enumerate(cols)],
            ["check", "failed_rows"],
        )
    )


def unique(df: DataFrame, relation: str, col: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = df.where(F.col(col).isNotNull()).groupBy(col).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failed_rows")).select(
        F.lit(f"{relation}.{col}.unique").alias("check"), "failed_rows"
    )


def unique_combination(df: DataFrame, relation: str, cols: list[str]) -> DataFrame:
    """Number of column combinations that occur more than once (NULLs grouped)."""
    dup = df.groupBy(*cols).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failed_rows")).select(
        F.lit(f"{relation}.{'_'.join(cols)}.unique_combination").alias("check"), "failed_rows"
    )


def accepted_values(df: DataFrame, relation: str, col: str, values: tuple[str, ...]) -> DataFrame:
    """Number of distinct non-NULL values outside ``values``."""
    bad = df.groupBy(col).count().where(~F.col(col).isin(*values))
    return bad.agg(F.count(F.lit(1)).alias("failed_rows")).select(
        F.lit(f"{relation}.{col}.accepted_values").alias("check"), "failed_rows"
    )


def min_rows(df: DataFrame, relation: str, minimum: int) -> DataFrame:
    """1 when the relation has fewer than ``minimum`` rows, else 0."""
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(f"{relation}.min_rows_{minimum}").alias("check"),
        F.when(F.col("_n") < minimum, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("failed_rows"),
    )


def max_lengths(df: DataFrame, relation: str, limits: dict[str, int]) -> DataFrame:
    """One row per column: values longer than the column's limit."""
    items = list(limits.items())
    wide = df.selectExpr(*[f"count_if(length(`{c}`) > {n}) AS _{i}" for i, (c, n) in enumerate(items)])
    return wide.selectExpr(
        stack_sql(
            [(sql_str(f"{relation}.{c}.max_length_{n}"), f"_{i}") for i, (c, n) in enumerate(items)],
            ["check", "failed_rows"],
        )
    )


def row_parity(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """|rows(source) - rows(target)|: two count passes folded into one row."""
    s = source.agg(F.count(F.lit(1)).alias("_n")).select(F.col("_n").alias("_s"), F.lit(0).cast("bigint").alias("_t"))
    t = target.agg(F.count(F.lit(1)).alias("_n")).select(F.lit(0).cast("bigint").alias("_s"), F.col("_n").alias("_t"))
    return s.unionByName(t).agg(
        F.abs(F.sum("_s") - F.sum("_t")).cast("bigint").alias("failed_rows")
    ).select(F.lit(f"{name}.row_parity").alias("check"), "failed_rows")


def observed_load(spark, name: str, source_rows: int, loaded_rows: int, minimum: int) -> DataFrame:
    """(check, observed_rows, failed_rows) from counts that the writing jobs took: reads no row again."""
    rows = [
        (f"{name}.observed_parity", loaded_rows, abs(source_rows - loaded_rows)),
        (f"{name}.observed_min_rows_{minimum}", loaded_rows, int(loaded_rows < minimum)),
    ]
    return spark.createDataFrame(rows, "check string, observed_rows bigint, failed_rows bigint")


def missing_columns(df: DataFrame, relation: str, required: tuple[str, ...], severity: str) -> DataFrame:
    """Required columns absent from ``df`` (case-insensitive): metadata only.

    Returns (check, column_name, severity) for each missing column; the
    caller raises for severity 'error' and logs for 'warn'.
    """
    present = {c.lower() for c in df.columns}
    missing = [c for c in required if c.lower() not in present]
    spark = df.sparkSession
    schema = "check string, column_name string, severity string"
    rows = [(f"{relation}.required_columns", c, severity) for c in missing]
    return spark.createDataFrame(rows, schema)


def contract(df: DataFrame, relation: str, expected: T.StructType) -> DataFrame:
    """Compare names, types and positions with the recorded contract (metadata only)."""
    actual = df.schema.fields
    rows = []
    for i in range(max(len(actual), len(expected.fields))):
        e = expected.fields[i] if i < len(expected.fields) else None
        a = actual[i] if i < len(actual) else None
        rows.append(
            (
                relation,
                i + 1,
                e.name if e else None,
                e.dataType.simpleString() if e else None,
                a.name if a else None,
                a.dataType.simpleString() if a else None,
                bool(e and a and e.name == a.name and e.dataType == a.dataType),
            )
        )
    schema = (
        "relation string, position int, expected_name string, expected_type string, "
        "actual_name string, actual_type string, ok boolean"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def enforce_columns(found: DataFrame, log=None) -> list[str]:
    """Act on (check, column_name, severity) rows: raise for errors, log warnings.

    The input has at most one row per expected column, so it is collected.
    Returns the missing columns that were only warned about.
    """
    import logging

    log = log or logging.getLogger("enrolmart")
    rows = found.collect()
    errors = sorted(r.column_name for r in rows if r.severity == "error")
    if errors:
        raise ValueError(f"required columns missing: {errors}")
    warned = sorted(r.column_name for r in rows if r.severity != "error")
    if warned:
        log.warning("expected columns not found (possible schema change): %s", warned)
    return warned


def failures(checks: DataFrame) -> list[tuple[str, int]]:
    """Collect the (small, one row per check) failing checks to the driver."""
    return [(r["check"], r["failed_rows"]) for r in checks.where(F.col("failed_rows") > 0).collect()]


def assert_checks(checks: DataFrame) -> None:
    bad = failures(checks)
    if bad:
        raise AssertionError(f"data checks failed: {bad}")


union_checks = _union

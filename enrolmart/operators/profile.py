"""Profiling operators: counts, distincts, duplicates, missing cells, statistics.

Every operator is one aggregate pass (partial aggregation map-side), except
the key-based ones (duplicates, exact quantiles) which need one shuffle on
their key.  Missing-key semantics follow the exploration notebook: group
sizes drop NULL keys, distinct counts ignore NULL, distinct lists keep it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.operators.ordering import quantiles_of, value_counts


def row_count(df: DataFrame, relation: str) -> DataFrame:
    """(relation, n_rows) as a one-row DataFrame; no driver round trip."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(relation).alias("relation"), "n_rows"
    )


def group_sizes(df: DataFrame, keys: list[str], name: str = "n_rows") -> DataFrame:
    """Rows per key combination; rows with a NULL key part are left out."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def stack_sql(rows: list[tuple[str, ...]], names: list[str]) -> str:
    """SQL ``stack`` (unpivot) of literal rows of expressions into ``names``."""
    body = ", ".join(", ".join(r) for r in rows)
    return f"stack({len(rows)}, {body}) AS ({', '.join(names)})"


def sql_str(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_cells(cols: list[str]) -> Column:
    """Number of NULL cells among ``cols`` in the current row."""
    return F.expr(" + ".join(f"CAST(`{c}` IS NULL AS INT)" for c in cols))


def distinct_counts(df: DataFrame, cols: dict[str, str], approx_rsd: float | None = None) -> DataFrame:
    """Distinct counts (NULL ignored), one output column per input column.

    Exact by default (one aggregation; Spark de-duplicates each column's
    values in a shuffle).  With ``approx_rsd`` a HyperLogLog++ sketch per
    column is merged map-side instead: no value shuffle, bounded memory,
    relative standard deviation ``approx_rsd``.
    """
    if approx_rsd is not None:
        return df.agg(
            *[F.approx_count_distinct(F.col(c), approx_rsd).alias(out) for c, out in cols.items()]
        )
    return df.agg(*[F.count_distinct(F.col(c)).alias(out) for c, out in cols.items()])


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column_name, value, pos): distinct values per column, NULL listed.

    One scan: the columns are unpivoted with ``stack`` and de-duplicated in
    one aggregation (partial, map-side).  ``pos`` orders values ascending
    with NULL last; each window partition holds the distinct values of one
    column, so it is bounded by that column's domain (years, months,
    levels, states).
    """
    long = df.selectExpr(
        stack_sql([(sql_str(c), f"CAST(`{c}` AS STRING)") for c in cols], ["column_name", "value"])
    ).distinct()
    w = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last())
    return long.withColumn("pos", F.row_number().over(w).cast("bigint"))


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """(n_rows, n_keys, n_duplicates): rows beyond the first per key, NULLs equal."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("_n") - 1).cast("bigint").alias("n_duplicates"),
    ).select(
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
        "n_keys",
        F.coalesce("n_duplicates", F.lit(0).cast("bigint")).alias("n_duplicates"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Long form (column_name, position, n_null): one aggregate, then unpivot."""
    cols = df.columns
    wide = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS _{i}" for i, c in enumerate(cols)])
    return wide.selectExpr(
        stack_sql(
            [(sql_str(c), str(i + 1), f"_{i}") for i, c in enumerate(cols)],
            ["column_name", "position", "n_null"],
        )
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Long form (column_name, position, data_type, n_non_null, n_rows)."""
    fields = df.schema.fields
    wide = df.selectExpr(
        "count(1) AS _rows", *[f"count(`{f.name}`) AS _{i}" for i, f in enumerate(fields)]
    )
    return wide.selectExpr(
        stack_sql(
            [
                (sql_str(f.name), str(i + 1), sql_str(f.dataType.simpleString()), f"_{i}", "_rows")
                for i, f in enumerate(fields)
            ],
            ["column_name", "position", "data_type", "n_non_null", "n_rows"],
        )
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (exact, linear), max per column.

    The columns are unpivoted once to (column, value) pairs with their
    counts; moments and quantiles are passes over those pairs.  Columns
    without a value have count 0 and NULL statistics.
    """
    long = df.selectExpr(
        stack_sql([(sql_str(c), f"CAST(`{c}` AS DOUBLE)") for c in cols], ["name", "value"])
    )
    pairs = value_counts(long, "name", "value")
    first = pairs.groupBy("k").agg(
        F.sum("c").alias("count"),
        (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    # Deviations from the mean (not a difference of large sums) keep the digits.
    square = (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))
    second = (
        pairs.join(first.select("k", "mean"), "k")
        .groupBy("k")
        .agg(F.sum(square * F.col("c")).alias("_ss"))
    )
    q = quantiles_of(pairs, (0.25, 0.5, 0.75))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    out = names.join(
        first.join(second, "k").join(q, "k"), F.col("column_name") == F.col("k"), "left"
    )
    return out.select(
        "column_name",
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))).alias("std"),
        "min",
        F.col("q_0").alias("p25"),
        F.col("q_1").alias("p50"),
        F.col("q_2").alias("p75"),
        "max",
    )

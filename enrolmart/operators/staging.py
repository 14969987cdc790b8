"""Typing and staging: landed strings -> typed raw -> 14-column staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrolmart.functions.expr import finite_sql, lower_columns, parse_double_sql
from enrolmart.schemas import DIMENSIONS, MEASURES, STG_RENAMES


def coerce_numeric(landed: DataFrame, measures=MEASURES) -> DataFrame:
    """Coerce the measure columns that are present to double.

    Unparseable and infinite values become NULL and the row is kept.  Columns
    are matched case-insensitively and the output names are lower case.
    """
    df = lower_columns(landed)
    wanted = {m.lower() for m in measures}
    # SQL text: 53 guarded casts parse once on the JVM.  The check for infinity
    # is a projection of its own, so each cast is evaluated (and generated) once.
    for step in (parse_double_sql, lambda c: finite_sql(f"`{c}`")):
        df = df.selectExpr(*[f"{step(c)} AS `{c}`" if c in wanted else f"`{c}`" for c in df.columns])
    return df


def typed_raw(landed: DataFrame) -> DataFrame:
    """Landed release -> the 60-column typed raw relation in contract order."""
    df = coerce_numeric(landed)
    return df.select(*DIMENSIONS, *MEASURES)


# A year that is present but not an integer stops the job, whatever the
# session's ANSI setting (a plain cast raises in the warehouse); a missing
# year stays NULL and is reported by the not-null check.
STRICT_YEAR = (
    "coalesce(try_cast(year AS INT), "
    "CASE WHEN year IS NOT NULL THEN raise_error(concat('invalid year: ', year)) END)"
)


def stg(raw: DataFrame) -> DataFrame:
    """Staging view: 60 -> 14 columns, 11 renamed, year cast to int (strictly)."""
    cols = []
    for src, dst in STG_RENAMES:
        if src == "year":
            cols.append(F.expr(STRICT_YEAR).alias(dst))
        else:
            cols.append(F.col(src).alias(dst))
    return raw.select(*cols)

"""The two marts: national by month and state by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.functions.expr import pct1_sql, report_date_sql
from enrolmart.schemas import ANNUAL_MONTH, STG_MEASURES, UNKNOWN_STATE


NATIONAL_ROWS = f"bene_geo_lvl = 'National' AND month != '{ANNUAL_MONTH}'"
BY_STATE_ROWS = f"bene_geo_lvl = 'State' AND month = '{ANNUAL_MONTH}' AND state != '{UNKNOWN_STATE}'"


def national_rows() -> Column:
    """Row filter of the national mart (NULL counts as false, like WHERE)."""
    return F.expr(NATIONAL_ROWS)


def by_state_rows() -> Column:
    """Row filter of the by-state mart; a NULL state fails ``!=`` and is dropped."""
    return F.expr(BY_STATE_ROWS)


_RATES = (
    f"{pct1_sql('medicare_advantage_benes', 'total_beneficiaries')} AS ma_penetration_rate",
    f"{pct1_sql('original_medicare_benes', 'total_beneficiaries')} AS ffs_penetration_rate",
)


def national(stg: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per month at national level (annual rows excluded).

    The filter sits directly over the staging projection, so Catalyst pushes
    ``bene_geo_lvl = 'National' AND month <> 'Year'`` into the Parquet scan.
    ``month != 'Year'`` drops a NULL month (three-valued logic), as in SQL.
    """
    df = stg.where(NATIONAL_ROWS).selectExpr(
        f"{report_date_sql('year', 'month')} AS report_date",
        *STG_MEASURES,
        *_RATES,
        "year",
        "month",
    )
    # The mart is one row per month, so the final range sort is tiny.
    return df.orderBy(F.col("report_date").asc_nulls_last()) if ordered else df


def by_state(stg: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per state and year from the annual State rows, unknown state left out.

    ``state != 'UK'`` also drops a NULL state (three-valued logic).
    """
    df = stg.where(BY_STATE_ROWS).selectExpr(
        "year", "state", "state_name", "fips_code", *STG_MEASURES, *_RATES
    )
    return df.orderBy(F.col("year").asc_nulls_last(), F.col("state").asc_nulls_last()) if ordered else df

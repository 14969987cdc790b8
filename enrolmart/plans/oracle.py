"""DuckDB SQL for the oracle side of every query.

The CTE chain mirrors the relations of the package (landed -> typed ->
stg -> national / by_state) but is written independently in SQL, so a
query's Spark plan and its oracle share only the fixed values (measure
conditions, month names, pattern).
"""

from __future__ import annotations

from enrolmart.functions.expr import NUMERIC_PATTERN
from enrolmart.plans.adapter import landed_raw_sql
from enrolmart.schemas import DIMENSIONS, MEASURES, MONTHS, STG_MEASURES, STG_RENAMES


def month_case(col: str) -> str:
    whens = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(MONTHS, start=1))
    return f"(CASE {col} {whens} END)"


def coerce_sql(col: str) -> str:
    return (
        f"CASE WHEN regexp_matches({col}, '{NUMERIC_PATTERN}') AND isfinite(TRY_CAST({col} AS DOUBLE)) "
        f"THEN TRY_CAST({col} AS DOUBLE) END"
    )


def pct1_sql(part: str, whole: str) -> str:
    return (
        f"CAST(round(CAST({part} / NULLIF({whole}, 0) * 100 AS DECIMAL(18,6)), 1) AS DECIMAL(18,1))"
    )


def _typed() -> str:
    cols = list(DIMENSIONS) + [f"{coerce_sql(m)} AS {m}" for m in MEASURES]
    return "typed AS (SELECT " + ", ".join(cols) + " FROM landed)"


def _stg() -> str:
    cols = []
    for src, dst in STG_RENAMES:
        cols.append(f"CAST({src} AS INTEGER) AS {dst}" if src == "year" else f"{src} AS {dst}")
    return "stg AS (SELECT " + ", ".join(cols) + " FROM typed)"


def _national() -> str:
    return (
        "national AS (SELECT make_date(year, "
        + month_case("month")
        + ", 1) AS report_date, "
        + ", ".join(STG_MEASURES)
        + ", "
        + pct1_sql("medicare_advantage_benes", "total_beneficiaries")
        + " AS ma_penetration_rate, "
        + pct1_sql("original_medicare_benes", "total_beneficiaries")
        + " AS ffs_penetration_rate, year, month FROM stg "
        "WHERE bene_geo_lvl = 'National' AND month != 'Year')"
    )


def _by_state() -> str:
    return (
        "by_state AS (SELECT year, state, state_name, fips_code, "
        + ", ".join(STG_MEASURES)
        + ", "
        + pct1_sql("medicare_advantage_benes", "total_beneficiaries")
        + " AS ma_penetration_rate, "
        + pct1_sql("original_medicare_benes", "total_beneficiaries")
        + " AS ffs_penetration_rate FROM stg "
        "WHERE bene_geo_lvl = 'State' AND month = 'Year' AND state != 'UK')"
    )


def with_chain(final_select: str, extra_ctes: str = "") -> str:
    """Prefix a final SELECT with the whole CTE chain (unused CTEs cost nothing)."""
    ctes = [landed_raw_sql().strip(), _typed(), _stg(), _national(), _by_state()]
    if extra_ctes:
        ctes.append(extra_ctes.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + final_select

"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver's tables through the adapter (or a relation
Spark derives from them), over whole tables.  Source and sink queries
first write the release to a fresh folder under the shared checkpoint
root, then read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from enrolmart.functions.expr import month_no, pct1, report_date
from enrolmart.operators import profile, quality
from enrolmart.plans import reports
from enrolmart.plans.oracle import month_case, pct1_sql, with_chain
from enrolmart.plans.relations import release, stored_raw
from enrolmart.sources.readers import empty_columns
from enrolmart.schemas import (
    CONTRACTS,
    DIMENSIONS,
    GEO_LEVELS,
    MEASURES,
    PROGRAM_SERIES,
    RACE_SERIES,
    RAW_KEY,
    VARCHAR_LIMITS,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Reference thresholds (parameters): minimum raw rows and national mart rows.
MIN_RAW_ROWS = 100_000
MIN_MART_ROWS = 100


def register(name: str, sql: str | None = None):
    """Register a query; its result is always a new DataFrame (own execution)."""

    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir).select("*")

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _key_sql() -> str:
    return ", ".join(RAW_KEY)


# --- expressions, staging, marts --------------------------------------------


@register("coerce_numeric", with_chain("SELECT * FROM typed"))
def q_coerce_numeric(spark, sf_dir):
    return release(spark, sf_dir).raw


@register("stg_enrollment", with_chain("SELECT * FROM stg"))
def q_stg(spark, sf_dir):
    return release(spark, sf_dir).stg


@register(
    "report_date",
    with_chain(
        f"SELECT year, month, bene_geo_lvl, state, county, {month_case('month')} AS month_no, "
        f"make_date(year, {month_case('month')}, 1) AS report_date FROM stg"
    ),
)
def q_report_date(spark, sf_dir):
    s = release(spark, sf_dir).stg
    return s.select(
        "year",
        "month",
        "bene_geo_lvl",
        "state",
        "county",
        month_no("month").alias("month_no"),
        report_date("year", "month").alias("report_date"),
    )


@register(
    "penetration_rates",
    with_chain(
        "SELECT year, month, bene_geo_lvl, state, county, "
        f"{pct1_sql('medicare_advantage_benes', 'total_beneficiaries')} AS ma_penetration_rate, "
        f"{pct1_sql('original_medicare_benes', 'total_beneficiaries')} AS ffs_penetration_rate FROM stg"
    ),
)
def q_rates(spark, sf_dir):
    s = release(spark, sf_dir).stg
    return s.select(
        "year",
        "month",
        "bene_geo_lvl",
        "state",
        "county",
        pct1("medicare_advantage_benes", "total_beneficiaries").alias("ma_penetration_rate"),
        pct1("original_medicare_benes", "total_beneficiaries").alias("ffs_penetration_rate"),
    )


@register(
    "mart_national",
    with_chain("SELECT *, row_number() OVER (ORDER BY report_date NULLS LAST) AS pos FROM national"),
)
def q_mart_national(spark, sf_dir):
    return reports.numbered(release(spark, sf_dir).national(), "report_date")


@register(
    "mart_by_state",
    with_chain("SELECT *, row_number() OVER (ORDER BY year NULLS LAST, state NULLS LAST) AS pos FROM by_state"),
)
def q_mart_by_state(spark, sf_dir):
    return reports.numbered(release(spark, sf_dir).by_state(), "year", "state")


# --- profile ----------------------------------------------------------------


@register(
    "row_counts",
    with_chain(
        "SELECT 'raw' AS relation, count(*) AS n_rows FROM typed UNION ALL "
        "SELECT 'stg', count(*) FROM stg UNION ALL "
        "SELECT 'national', count(*) FROM national UNION ALL "
        "SELECT 'by_state', count(*) FROM by_state"
    ),
)
def q_row_counts(spark, sf_dir):
    r = release(spark, sf_dir)
    rels = {"raw": r.raw, "stg": r.stg, "national": r.national(), "by_state": r.by_state()}
    return quality.union_checks([profile.row_count(df, k) for k, df in rels.items()])


@register(
    "rows_per_year",
    with_chain("SELECT year, count(*) AS n_rows FROM typed WHERE year IS NOT NULL GROUP BY year"),
)
def q_rows_per_year(spark, sf_dir):
    return profile.group_sizes(release(spark, sf_dir).raw, ["year"])


_MISSING_SQL = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in DIMENSIONS + MEASURES)


@register(
    "rows_per_level",
    with_chain(
        "SELECT bene_geo_lvl, count(*) AS n_rows, "
        f"CAST(sum({_MISSING_SQL}) AS BIGINT) AS n_missing_cells "
        "FROM typed WHERE bene_geo_lvl IS NOT NULL GROUP BY bene_geo_lvl"
    ),
)
def q_rows_per_level(spark, sf_dir):
    raw = stored_raw(spark, sf_dir)
    return (
        raw.where(F.col("bene_geo_lvl").isNotNull())
        .groupBy("bene_geo_lvl")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(profile.missing_cells(list(DIMENSIONS + MEASURES))).cast("bigint").alias("n_missing_cells"),
        )
    )


@register(
    "rows_per_year_month",
    with_chain(
        "SELECT year, month, count(*) AS n_rows FROM typed "
        "WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month"
    ),
)
def q_rows_per_year_month(spark, sf_dir):
    return profile.group_sizes(release(spark, sf_dir).raw, ["year", "month"])


@register(
    "distinct_counts",
    with_chain(
        "SELECT count(DISTINCT year) AS n_years, count(DISTINCT month) AS n_months, "
        "count(DISTINCT bene_state_abrvtn) AS n_states, count(DISTINCT bene_county_desc) AS n_counties "
        "FROM typed"
    ),
)
def q_distinct_counts(spark, sf_dir):
    return profile.distinct_counts(
        release(spark, sf_dir).raw,
        {
            "year": "n_years",
            "month": "n_months",
            "bene_state_abrvtn": "n_states",
            "bene_county_desc": "n_counties",
        },
    )


_DISTINCT_COLS = ("year", "month", "bene_geo_lvl", "bene_state_abrvtn")


@register(
    "distinct_values",
    with_chain(
        "SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value NULLS LAST) AS pos "
        "FROM ("
        + " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM typed"
            for c in _DISTINCT_COLS
        )
        + ")"
    ),
)
def q_distinct_values(spark, sf_dir):
    return profile.distinct_values(release(spark, sf_dir).raw, list(_DISTINCT_COLS))


@register(
    "duplicate_rows",
    with_chain(
        f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates "
        f"FROM (SELECT count(*) AS n FROM typed GROUP BY {_key_sql()})"
    ),
)
def q_duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(release(spark, sf_dir).raw, list(RAW_KEY))


_ALL_COLS = DIMENSIONS + MEASURES


@register(
    "null_counts",
    with_chain(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {i + 1} AS position, _{i} AS n_null FROM agg"
            for i, c in enumerate(_ALL_COLS)
        ),
        "agg AS (SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS _{i}" for i, c in enumerate(_ALL_COLS))
        + " FROM typed)",
    ),
)
def q_null_counts(spark, sf_dir):
    return profile.null_counts(stored_raw(spark, sf_dir))


@register(
    "describe_measures",
    with_chain(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, min({c}) AS min, "
            f"quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
            f"quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM typed"
            for c in MEASURES
        )
    ),
)
def q_describe(spark, sf_dir):
    """All 53 measures; mean and std are rounded here for the comparison only."""
    out = profile.describe(stored_raw(spark, sf_dir), list(MEASURES))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@register(
    "table_profile",
    with_chain(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS column_name, {i + 1} AS position, "
            f"'{f.dataType.simpleString()}' AS data_type, _{i} AS n_non_null, _rows AS n_rows FROM agg"
            for i, f in enumerate(CONTRACTS["raw"].fields)
        ),
        "agg AS (SELECT count(*) AS _rows, "
        + ", ".join(f"count({f.name}) AS _{i}" for i, f in enumerate(CONTRACTS["raw"].fields))
        + " FROM typed)",
    ),
)
def q_table_profile(spark, sf_dir):
    return profile.table_profile(release(spark, sf_dir).raw)


@register(
    "preview_rows",
    with_chain(
        f"SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {_key_sql()}) AS pos FROM typed) "
        "WHERE pos <= 10"
    ),
)
def q_preview_rows(spark, sf_dir):
    raw = release(spark, sf_dir).raw
    order = [F.col(c).asc_nulls_last() for c in RAW_KEY]
    top = raw.orderBy(*order).limit(10)  # the feature: a 10-row preview (top-k per task, then merge)
    return top.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


# --- quality ----------------------------------------------------------------

_NN = {
    "stg": ("year", "month", "bene_geo_lvl"),
    "national": ("report_date", "year", "month", "total_beneficiaries"),
    "by_state": ("year", "state", "state_name", "fips_code", "total_beneficiaries"),
}


@register(
    "dq_not_null",
    with_chain(
        " UNION ALL ".join(
            f"SELECT '{rel}.{c}.not_null' AS check, count(*) FILTER (WHERE {c} IS NULL) AS failed_rows FROM {rel}"
            for rel, cols in _NN.items()
            for c in cols
        )
    ),
)
def q_dq_not_null(spark, sf_dir):
    r = release(spark, sf_dir)
    rels = {"stg": r.stg, "national": r.national(), "by_state": r.by_state()}
    return quality.union_checks([quality.not_null(rels[k], k, list(c)) for k, c in _NN.items()])


# Checks on input derived from the tables that breaks them: each row must count its failures.


@register(
    "dq_not_null_broken",
    with_chain(
        " UNION ALL ".join(
            f"SELECT 'raw.{c}.not_null' AS check, count(*) FILTER (WHERE {c} IS NULL) AS failed_rows FROM typed"
            for c in MEASURES
        )
    ),
)
def q_dq_not_null_broken(spark, sf_dir):
    """The raw measures, whose suppressed cells are missing."""
    return quality.not_null(stored_raw(spark, sf_dir), "raw", list(MEASURES))


@register(
    "dq_unique_broken",
    "SELECT 'orders.o_custkey.unique' AS check, count(*) AS failed_rows FROM "
    "(SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1)",
)
def q_dq_unique_broken(spark, sf_dir):
    return quality.unique(spark.read.parquet(f"{sf_dir}/orders.parquet"), "orders", "o_custkey")


@register(
    "dq_unique_combo_broken",
    "SELECT 'orders.o_custkey_o_orderstatus.unique_combination' AS check, count(*) AS failed_rows FROM "
    "(SELECT 1 FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)",
)
def q_dq_unique_combo_broken(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return quality.unique_combination(orders, "orders", ["o_custkey", "o_orderstatus"])


@register(
    "dq_accepted_values_broken",
    "SELECT 'customer.c_mktsegment.accepted_values' AS check, count(*) AS failed_rows FROM "
    "(SELECT c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment)",
)
def q_dq_accepted_broken(spark, sf_dir):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return quality.accepted_values(customer, "customer", "c_mktsegment", ("BUILDING",))


_SHORT = {"bene_geo_lvl": 5, "bene_county_desc": 8, "month": 4}


@register(
    "dq_lengths_broken",
    with_chain(
        " UNION ALL ".join(
            f"SELECT 'raw.{c}.max_length_{n}' AS check, count(*) FILTER (WHERE length({c}) > {n}) AS failed_rows FROM typed"
            for c, n in _SHORT.items()
        )
    ),
)
def q_dq_lengths_broken(spark, sf_dir):
    return quality.max_lengths(release(spark, sf_dir).raw, "raw", _SHORT)


_LOST = ("aged_esrd_benes", "bene_state_desc")


@register(
    "dq_missing_columns_broken",
    with_chain(
        " UNION ALL ".join(
            f"SELECT 'landed.required_columns' AS check, '{c}' AS column_name, 'warn' AS severity "
            f"FROM (SELECT count(x) AS n FROM (SELECT {'NULL' if c in _LOST else c} AS x FROM landed)) WHERE n = 0"
            for c in (*DIMENSIONS, *MEASURES)
        )
    ),
)
def q_dq_missing_columns_broken(spark, sf_dir):
    """A landing that lost two of its columns."""
    landed = release(spark, sf_dir).landed
    lost = landed.withColumns({c: F.lit(None).cast("string") for c in _LOST})
    return empty_columns(lost, "landed", DIMENSIONS + MEASURES, "warn")


@register(
    "dq_unique",
    with_chain(
        "SELECT 'national.report_date.unique' AS check, count(*) AS failed_rows FROM "
        "(SELECT report_date FROM national WHERE report_date IS NOT NULL GROUP BY report_date HAVING count(*) > 1)"
    ),
)
def q_dq_unique(spark, sf_dir):
    return quality.unique(release(spark, sf_dir).national(), "national", "report_date")


@register(
    "dq_unique_combo",
    with_chain(
        "SELECT 'national.year_month.unique_combination' AS check, count(*) AS failed_rows FROM "
        "(SELECT year, month FROM national GROUP BY year, month HAVING count(*) > 1) UNION ALL "
        "SELECT 'by_state.year_state.unique_combination', count(*) FROM "
        "(SELECT year, state FROM by_state GROUP BY year, state HAVING count(*) > 1)"
    ),
)
def q_dq_unique_combo(spark, sf_dir):
    r = release(spark, sf_dir)
    return quality.union_checks(
        [
            quality.unique_combination(r.national(), "national", ["year", "month"]),
            quality.unique_combination(r.by_state(), "by_state", ["year", "state"]),
        ]
    )


_LEVELS_SQL = ", ".join(f"'{v}'" for v in GEO_LEVELS)


@register(
    "dq_accepted_values",
    with_chain(
        "SELECT 'stg.bene_geo_lvl.accepted_values' AS check, count(*) AS failed_rows FROM "
        f"(SELECT bene_geo_lvl FROM stg WHERE bene_geo_lvl NOT IN ({_LEVELS_SQL}) GROUP BY bene_geo_lvl)"
    ),
)
def q_dq_accepted(spark, sf_dir):
    return quality.accepted_values(release(spark, sf_dir).stg, "stg", "bene_geo_lvl", GEO_LEVELS)


@register(
    "dq_min_rows",
    with_chain(
        f"SELECT 'raw.min_rows_{MIN_RAW_ROWS}' AS check, "
        f"CAST(CASE WHEN count(*) < {MIN_RAW_ROWS} THEN 1 ELSE 0 END AS BIGINT) AS failed_rows FROM typed "
        f"UNION ALL SELECT 'national.min_rows_{MIN_MART_ROWS}', "
        f"CAST(CASE WHEN count(*) < {MIN_MART_ROWS} THEN 1 ELSE 0 END AS BIGINT) FROM national"
    ),
)
def q_dq_min_rows(spark, sf_dir):
    r = release(spark, sf_dir)
    return quality.union_checks(
        [
            quality.min_rows(r.raw, "raw", MIN_RAW_ROWS),
            quality.min_rows(r.national(), "national", MIN_MART_ROWS),
        ]
    )


@register(
    "dq_lengths",
    with_chain(
        " UNION ALL ".join(
            f"SELECT 'raw.{c}.max_length_{n}' AS check, count(*) FILTER (WHERE length({c}) > {n}) AS failed_rows FROM typed"
            for c, n in VARCHAR_LIMITS.items()
        )
    ),
)
def q_dq_lengths(spark, sf_dir):
    return quality.max_lengths(release(spark, sf_dir).raw, "raw", VARCHAR_LIMITS)


# --- reports ----------------------------------------------------------------

_M = "CAST(1000000 AS DOUBLE)"
_K = "CAST(1000 AS DOUBLE)"


@register(
    "kpi_cards",
    with_chain(
        "SELECT report_date, strftime(report_date, '%B %Y') AS report_label, total_beneficiaries, "
        "medicare_advantage_benes, original_medicare_benes, ma_penetration_rate, ffs_penetration_rate, "
        "mom_total, mom_ma, mom_ffs, "
        f"total_beneficiaries / {_M} AS total_millions, medicare_advantage_benes / {_M} AS ma_millions, "
        f"original_medicare_benes / {_M} AS ffs_millions, mom_total / {_K} AS mom_total_thousands, "
        f"mom_ma / {_K} AS mom_ma_thousands, mom_ffs / {_K} AS mom_ffs_thousands, "
        f"format('{{:.1f}}M', total_beneficiaries / {_M}) AS total_short_label, "
        f"format('{{:.2f}}M', total_beneficiaries / {_M}) AS total_label, "
        f"format('{{:.2f}}M ({{}}%)', medicare_advantage_benes / {_M}, CAST(ma_penetration_rate AS VARCHAR)) AS ma_label, "
        f"format('{{:.2f}}M ({{}}%)', original_medicare_benes / {_M}, CAST(ffs_penetration_rate AS VARCHAR)) AS ffs_label, "
        f"format('{{:+.0f}}K', mom_total / {_K}) AS mom_total_label, "
        f"format('{{:+.0f}}K', mom_ma / {_K}) AS mom_ma_label, "
        f"format('{{:+.0f}}K', mom_ffs / {_K}) AS mom_ffs_label, "
        f"CAST(trunc(total_beneficiaries / {_M})::BIGINT AS VARCHAR) || 'M' AS axis_label "
        "FROM t WHERE rn = 1",
        "t AS (SELECT *, "
        "total_beneficiaries - lag(total_beneficiaries) OVER (ORDER BY report_date) AS mom_total, "
        "medicare_advantage_benes - lag(medicare_advantage_benes) OVER (ORDER BY report_date) AS mom_ma, "
        "original_medicare_benes - lag(original_medicare_benes) OVER (ORDER BY report_date) AS mom_ffs, "
        "row_number() OVER (ORDER BY report_date DESC) AS rn FROM national WHERE report_date IS NOT NULL)",
    ),
)
def q_kpi(spark, sf_dir):
    return reports.kpi_cards(release(spark, sf_dir).national())


@register(
    "mom_series",
    with_chain(
        "SELECT report_date, total_beneficiaries, medicare_advantage_benes, original_medicare_benes, "
        "total_beneficiaries - lag(total_beneficiaries) OVER (ORDER BY report_date) AS mom_total, "
        "medicare_advantage_benes - lag(medicare_advantage_benes) OVER (ORDER BY report_date) AS mom_ma, "
        "original_medicare_benes - lag(original_medicare_benes) OVER (ORDER BY report_date) AS mom_ffs "
        "FROM national"
    ),
)
def q_mom_series(spark, sf_dir):
    return reports.mom_series(release(spark, sf_dir).national())


@register(
    "program_share",
    with_chain(
        "SELECT *, beneficiaries / sum(beneficiaries) OVER (PARTITION BY report_date) * CAST(100 AS DOUBLE) AS share_pct FROM u",
        "l AS (SELECT * FROM national WHERE report_date IS NOT NULL ORDER BY report_date DESC LIMIT 1), "
        "u AS (SELECT report_date, 1 AS series_no, 'Medicare Advantage' AS program, "
        "medicare_advantage_benes AS beneficiaries FROM l UNION ALL "
        "SELECT report_date, 2, 'Fee-for-Service', original_medicare_benes FROM l)",
    ),
)
def q_program_share(spark, sf_dir):
    return reports.program_share(release(spark, sf_dir).national())


@register(
    "state_year_bounds",
    with_chain(
        "SELECT min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS n_years FROM by_state"
    ),
)
def q_state_year_bounds(spark, sf_dir):
    return reports.state_year_bounds(release(spark, sf_dir).by_state())


@register(
    "state_year_slice",
    with_chain("SELECT * FROM by_state WHERE year = (SELECT max(year) FROM by_state)"),
)
def q_state_year_slice(spark, sf_dir):
    return reports.state_year_slice(release(spark, sf_dir).by_state())


@register(
    "state_table",
    with_chain(
        "SELECT state_name AS \"State\", state AS \"Abbr\", "
        "format('{:,.0f}', total_beneficiaries) AS \"Total\", "
        "format('{:,.0f}', original_medicare_benes) AS \"FFS\", "
        "format('{:,.0f}', medicare_advantage_benes) AS \"MA\", "
        "CAST(ffs_penetration_rate AS VARCHAR) || '%' AS \"FFS %\", "
        "CAST(ma_penetration_rate AS VARCHAR) || '%' AS \"MA %\", "
        "row_number() OVER (ORDER BY total_beneficiaries DESC NULLS LAST, state ASC NULLS LAST) AS pos "
        "FROM by_state WHERE year = (SELECT max(year) FROM by_state)"
    ),
)
def q_state_table(spark, sf_dir):
    return reports.state_table(release(spark, sf_dir).by_state())


@register(
    "annual_trend",
    with_chain(
        f"SELECT report_date, year, total_beneficiaries / {_M} AS total_millions, "
        f"medicare_advantage_benes / {_M} AS ma_millions, original_medicare_benes / {_M} AS ffs_millions, "
        "ma_penetration_rate, ffs_penetration_rate FROM national WHERE month = 'January'"
    ),
)
def q_annual_trend(spark, sf_dir):
    return reports.annual_trend(release(spark, sf_dir).national())


def _stack_sql(
    source: str, series: list[tuple[str, str]], where: str, value_cast: str | None = None
) -> tuple[str, str]:
    parts = []
    for i, (c, label) in enumerate(series, start=1):
        v = f"CAST({c} AS {value_cast})" if value_cast else c
        parts.append(
            f"SELECT report_date, {i} AS series_no, '{label}' AS series, {v} AS value FROM src"
        )
    return (
        "SELECT *, sum(value) OVER (PARTITION BY report_date ORDER BY series_no "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stacked FROM ("
        + " UNION ALL ".join(parts)
        + ")",
        f"src AS (SELECT * FROM {source} WHERE {where})",
    )


_SHARE_SERIES = [("ffs_penetration_rate", "Fee-for-Service"), ("ma_penetration_rate", "Medicare Advantage")]
_DESC_WHERE = "month != 'Year' AND bene_state_desc = 'National'"
_DESC_SRC = (
    f"(SELECT *, make_date(CAST(year AS INTEGER), {month_case('month')}, 1) AS report_date FROM typed)"
)


@register(
    "stack_share",
    with_chain(
        "SELECT report_date, series_no, series, value, CAST(stacked AS DECIMAL(18,1)) AS stacked FROM ("
        + _stack_sql("national", _SHARE_SERIES, "month = 'January'")[0]
        + ")",
        _stack_sql("national", _SHARE_SERIES, "month = 'January'")[1],
    ),
)
def q_stack_share(spark, sf_dir):
    out = reports.stack_share(release(spark, sf_dir).national())
    return out.withColumn("stacked", F.col("stacked").cast("decimal(18,1)"))


@register("stack_program", with_chain(*_stack_sql(_DESC_SRC, list(PROGRAM_SERIES), _DESC_WHERE)))
def q_stack_program(spark, sf_dir):
    return reports.stack_program(release(spark, sf_dir).raw)


@register("stack_race", with_chain(*_stack_sql(_DESC_SRC, list(RACE_SERIES), _DESC_WHERE)))
def q_stack_race(spark, sf_dir):
    return reports.stack_race(release(spark, sf_dir).raw)


@register(
    "national_by_desc",
    with_chain(
        "SELECT report_date, coalesce(sum(tot_benes), CAST(0 AS DOUBLE)) AS tot_benes, count(*) AS n_rows "
        f"FROM {_DESC_SRC} WHERE {_DESC_WHERE} AND report_date IS NOT NULL GROUP BY report_date"
    ),
)
def q_national_by_desc(spark, sf_dir):
    return reports.national_total_by_date(release(spark, sf_dir).raw)


@register(
    "total_enrollment",
    with_chain(
        "SELECT year, month, bene_geo_lvl, bene_state_abrvtn, bene_county_desc, tot_benes, "
        f"make_date(CAST(year AS INTEGER), {month_case('month')}, 1) AS report_date, "
        f"row_number() OVER (ORDER BY {_key_sql()}) AS pos FROM typed WHERE month != 'Year'"
    ),
)
def q_total_enrollment(spark, sf_dir):
    return reports.total_enrollment(release(spark, sf_dir).raw)


@register(
    "monthly_change",
    with_chain(
        "SELECT report_date, total_beneficiaries, coalesce(total_beneficiaries - "
        "lag(total_beneficiaries) OVER (ORDER BY report_date), total_beneficiaries) AS monthly_new_benes "
        "FROM national"
    ),
)
def q_monthly_change(spark, sf_dir):
    return reports.monthly_change(release(spark, sf_dir).national())


@register(
    "monthly_change_text_order",
    with_chain(
        "SELECT year, month, tot_benes, coalesce(tot_benes - lag(tot_benes) OVER (ORDER BY year, month), "
        "tot_benes) AS monthly_new_benes, row_number() OVER (ORDER BY year, month) AS pos "
        "FROM typed WHERE bene_geo_lvl = 'National' AND month != 'Year'"
    ),
)
def q_monthly_change_text(spark, sf_dir):
    return reports.monthly_change_text_order(release(spark, sf_dir).raw)


@register(
    "monthly_change_text_order_all",
    with_chain(
        "SELECT year, month, bene_geo_lvl, bene_state_abrvtn, bene_county_desc, tot_benes, "
        "row_number() OVER w AS pos, "
        "coalesce(tot_benes - lag(tot_benes) OVER w, tot_benes) AS monthly_new_benes "
        f"FROM typed WHERE month != 'Year' WINDOW w AS (ORDER BY {_key_sql()})"
    ),
)
def q_monthly_change_text_all(spark, sf_dir):
    return reports.monthly_change_text_order_all(release(spark, sf_dir).raw)


@register(
    "monthly_change_by_geo",
    with_chain(
        "SELECT bene_geo_lvl, bene_state_abrvtn, bene_county_desc, report_date, tot_benes, "
        "coalesce(tot_benes - lag(tot_benes) OVER (PARTITION BY bene_geo_lvl, bene_state_abrvtn, "
        "bene_county_desc ORDER BY report_date), tot_benes) AS monthly_new_benes "
        f"FROM {_DESC_SRC} WHERE month != 'Year'"
    ),
)
def q_monthly_change_by_geo(spark, sf_dir):
    return reports.monthly_change_by_geo(release(spark, sf_dir).raw)

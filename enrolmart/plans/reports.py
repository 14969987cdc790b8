"""Dashboard and notebook queries over the marts and the typed raw relation.

Windows without ``partitionBy`` appear only over the national mart, which
holds one row per month (its uniqueness is a data check), so the single
window partition is bounded by the number of months.  Stacking windows
partition by date.  Orderings over unreduced data use ``with_position``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.functions.expr import (
    format_count,
    format_rate,
    millions_label,
    report_date,
    signed_thousands_label,
    whole_millions_label,
)
from enrolmart.operators.ordering import with_position, with_previous
from enrolmart.schemas import ANNUAL_MONTH, PROGRAM_SERIES, RACE_SERIES



def _by_date() -> Window:
    return Window.orderBy(F.col("report_date").asc_nulls_last())


def kpi_cards(national: DataFrame) -> DataFrame:
    """Latest month: values, rates, month-over-month deltas, scaled values, label."""
    last_two = national.where(F.col("report_date").isNotNull()).orderBy(
        F.col("report_date").desc()
    ).limit(2)  # top-k: the feature is "latest and previous"
    w = Window.orderBy("report_date")
    d = last_two.select(
        "*",
        (F.col("total_beneficiaries") - F.lag("total_beneficiaries").over(w)).alias("mom_total"),
        (F.col("medicare_advantage_benes") - F.lag("medicare_advantage_benes").over(w)).alias("mom_ma"),
        (F.col("original_medicare_benes") - F.lag("original_medicare_benes").over(w)).alias("mom_ffs"),
        F.row_number().over(Window.orderBy(F.col("report_date").desc())).alias("_rn"),
    ).where(F.col("_rn") == 1)
    return d.select(
        "report_date",
        F.date_format("report_date", "MMMM yyyy").alias("report_label"),
        "total_beneficiaries",
        "medicare_advantage_benes",
        "original_medicare_benes",
        "ma_penetration_rate",
        "ffs_penetration_rate",
        "mom_total",
        "mom_ma",
        "mom_ffs",
        (F.col("total_beneficiaries") / 1e6).alias("total_millions"),
        (F.col("medicare_advantage_benes") / 1e6).alias("ma_millions"),
        (F.col("original_medicare_benes") / 1e6).alias("ffs_millions"),
        (F.col("mom_total") / 1e3).alias("mom_total_thousands"),
        (F.col("mom_ma") / 1e3).alias("mom_ma_thousands"),
        (F.col("mom_ffs") / 1e3).alias("mom_ffs_thousands"),
        millions_label("total_beneficiaries", 1).alias("total_short_label"),
        millions_label("total_beneficiaries", 2).alias("total_label"),
        F.concat_ws(
            " ",
            millions_label("medicare_advantage_benes", 2),
            F.concat(F.lit("("), format_rate("ma_penetration_rate"), F.lit(")")),
        ).alias("ma_label"),
        F.concat_ws(
            " ",
            millions_label("original_medicare_benes", 2),
            F.concat(F.lit("("), format_rate("ffs_penetration_rate"), F.lit(")")),
        ).alias("ffs_label"),
        signed_thousands_label("mom_total").alias("mom_total_label"),
        signed_thousands_label("mom_ma").alias("mom_ma_label"),
        signed_thousands_label("mom_ffs").alias("mom_ffs_label"),
        whole_millions_label("total_beneficiaries").alias("axis_label"),
    )


def mom_series(national: DataFrame) -> DataFrame:
    """Month-over-month deltas for every month (first month NULL)."""
    return national.select(
        "report_date",
        "total_beneficiaries",
        "medicare_advantage_benes",
        "original_medicare_benes",
        (F.col("total_beneficiaries") - F.lag("total_beneficiaries").over(_by_date())).alias("mom_total"),
        (F.col("medicare_advantage_benes") - F.lag("medicare_advantage_benes").over(_by_date())).alias("mom_ma"),
        (F.col("original_medicare_benes") - F.lag("original_medicare_benes").over(_by_date())).alias("mom_ffs"),
    )


def program_share(national: DataFrame) -> DataFrame:
    """Donut data: MA and FFS counts of the latest month and their shares of the two."""
    latest = national.where(F.col("report_date").isNotNull()).orderBy(
        F.col("report_date").desc()
    ).limit(1)
    long = latest.select(
        "report_date",
        F.explode(
            F.array(
                F.struct(
                    F.lit(1).alias("series_no"),
                    F.lit("Medicare Advantage").alias("program"),
                    F.col("medicare_advantage_benes").alias("beneficiaries"),
                ),
                F.struct(
                    F.lit(2).alias("series_no"),
                    F.lit("Fee-for-Service").alias("program"),
                    F.col("original_medicare_benes").alias("beneficiaries"),
                ),
            )
        ).alias("s"),
    ).select("report_date", "s.*")
    w = Window.partitionBy("report_date")
    return long.withColumn(
        "share_pct", F.col("beneficiaries") / F.sum("beneficiaries").over(w) * 100.0
    )


def _latest_year(by_state: DataFrame) -> DataFrame:
    # The mart has one row per state and year, so its one window partition is
    # bounded by states x years; a join to its own maximum would derive it twice.
    top = by_state.withColumn("_top", F.max("year").over(Window.partitionBy(F.lit(1))))
    return top.where(F.col("year") == F.col("_top")).drop("_top")


def state_year_bounds(by_state: DataFrame) -> DataFrame:
    return by_state.agg(
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.count_distinct("year").alias("n_years"),
    )


def state_year_slice(by_state: DataFrame, year: int | None = None) -> DataFrame:
    """Map data: the by-state rows of one year (default: the latest year)."""
    if year is None:
        return _latest_year(by_state)
    return by_state.where(F.col("year") == year)


def state_table(by_state: DataFrame, year: int | None = None) -> DataFrame:
    """Display table: seven relabelled, formatted columns, largest state first."""
    rows = state_year_slice(by_state, year)
    # One year's states: the by-state mart is unique on (year, state), so
    # this window partition is bounded by the number of states.
    w = Window.orderBy(F.col("total_beneficiaries").desc_nulls_last(), F.col("state").asc_nulls_last())
    ordered = rows.withColumn("pos", F.row_number().over(w).cast("bigint"))
    return ordered.select(
        F.col("state_name").alias("State"),
        F.col("state").alias("Abbr"),
        format_count("total_beneficiaries").alias("Total"),
        format_count("original_medicare_benes").alias("FFS"),
        format_count("medicare_advantage_benes").alias("MA"),
        format_rate("ffs_penetration_rate").alias("FFS %"),
        format_rate("ma_penetration_rate").alias("MA %"),
        "pos",
    )


def annual_trend(national: DataFrame) -> DataFrame:
    """One point per year (January), counts in millions, both rates."""
    return national.where(F.col("month") == "January").select(
        "report_date",
        "year",
        (F.col("total_beneficiaries") / 1e6).alias("total_millions"),
        (F.col("medicare_advantage_benes") / 1e6).alias("ma_millions"),
        (F.col("original_medicare_benes") / 1e6).alias("ffs_millions"),
        "ma_penetration_rate",
        "ffs_penetration_rate",
    )


def _stack(wide: DataFrame, series: list[tuple[str, str]], value_type: str | None = None) -> DataFrame:
    """Unpivot series columns and add the stacked (running) value per date."""
    long = wide.select(
        "report_date",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("series_no"),
                        F.lit(label).alias("series"),
                        (F.col(c).cast(value_type) if value_type else F.col(c)).alias("value"),
                    )
                    for i, (c, label) in enumerate(series, start=1)
                ]
            )
        ).alias("s"),
    ).select("report_date", "s.*")
    w = (
        Window.partitionBy("report_date")
        .orderBy("series_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return long.withColumn("stacked", F.sum("value").over(w))


def stack_share(national: DataFrame) -> DataFrame:
    """Stacked shares per January: FFS first, then MA."""
    jan = national.where(F.col("month") == "January")
    return _stack(
        jan,
        [("ffs_penetration_rate", "Fee-for-Service"), ("ma_penetration_rate", "Medicare Advantage")],
    )


def national_by_desc(raw: DataFrame) -> DataFrame:
    """National rows chosen by description, monthly only, with their date."""
    return raw.where((F.col("month") != ANNUAL_MONTH) & (F.col("bene_state_desc") == "National")).withColumn(
        "report_date", report_date("year", "month")
    )


def national_total_by_date(raw: DataFrame) -> DataFrame:
    """Sum of tot_benes per date over the national-by-description rows (0 if all missing)."""
    return (
        national_by_desc(raw)
        .where(F.col("report_date").isNotNull())
        .groupBy("report_date")
        .agg(
            F.coalesce(F.sum("tot_benes"), F.lit(0.0)).alias("tot_benes"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def stack_program(raw: DataFrame) -> DataFrame:
    return _stack(national_by_desc(raw), list(PROGRAM_SERIES))


def stack_race(raw: DataFrame) -> DataFrame:
    return _stack(national_by_desc(raw), list(RACE_SERIES))


def _text_order() -> list[Column]:
    names = ("year", "month", "bene_geo_lvl", "bene_state_abrvtn", "bene_county_desc")
    return [F.col(c).asc_nulls_last() for c in names]


def _monthly(raw: DataFrame) -> DataFrame:
    """The monthly rows of all levels with their report date."""
    return raw.where(F.col("month") != ANNUAL_MONTH).select(
        "year",
        "month",
        "bene_geo_lvl",
        "bene_state_abrvtn",
        "bene_county_desc",
        "tot_benes",
        report_date("year", "month").alias("report_date"),
    )


def total_enrollment(raw: DataFrame) -> DataFrame:
    """Monthly rows of every level with a date, in text order of (year, month).

    Ties within (year, month) are broken by the raw key so the position is
    deterministic; the position is computed without a single-task window.
    """
    return with_position(_monthly(raw), _text_order())


def monthly_change(national: DataFrame) -> DataFrame:
    """First difference of the national total by date; the first month keeps its total."""
    return national.select(
        "report_date",
        "total_beneficiaries",
        F.coalesce(
            F.col("total_beneficiaries") - F.lag("total_beneficiaries").over(_by_date()),
            F.col("total_beneficiaries"),
        ).alias("monthly_new_benes"),
    )


def monthly_change_by_geo(raw: DataFrame) -> DataFrame:
    """First difference of tot_benes by date within each geography (all levels).

    The window is partitioned by geography (level, state, county): each
    partition holds one geography's months, so it is bounded by the number
    of months, and the work spreads over all tasks.  A missing value yields
    the row's own total, like a difference filled with the total.
    """
    rows = raw.where(F.col("month") != ANNUAL_MONTH).select(
        "bene_geo_lvl",
        "bene_state_abrvtn",
        "bene_county_desc",
        report_date("year", "month").alias("report_date"),
        "tot_benes",
    )
    w = Window.partitionBy("bene_geo_lvl", "bene_state_abrvtn", "bene_county_desc").orderBy(
        F.col("report_date").asc_nulls_last()
    )
    return rows.withColumn(
        "monthly_new_benes",
        F.coalesce(F.col("tot_benes") - F.lag("tot_benes").over(w), F.col("tot_benes")),
    )


def monthly_change_text_order(raw: DataFrame) -> DataFrame:
    """The literal form: National monthly rows in text order of (year, month).

    Text order puts April first within a year; the first row keeps its total.
    One row per month, so the single window partition is bounded.
    """
    nat = raw.where((F.col("bene_geo_lvl") == "National") & (F.col("month") != ANNUAL_MONTH))
    w = Window.orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())
    return nat.select(
        "year",
        "month",
        "tot_benes",
        F.coalesce(F.col("tot_benes") - F.lag("tot_benes").over(w), F.col("tot_benes")).alias(
            "monthly_new_benes"
        ),
        F.row_number().over(w).cast("bigint").alias("pos"),
    )


def monthly_change_text_order_all(raw: DataFrame) -> DataFrame:
    """The literal form over all levels: each row against the row before it in text order.

    Rows are numbered in (year, month) text order, ties by the raw key; each
    range of that order hands its last value to the next one, so no task orders
    all rows and no row is joined.
    """
    rows = with_previous(_monthly(raw), _text_order(), "tot_benes", "_before").drop("report_date")
    return rows.select(
        *[c for c in rows.columns if c != "_before"],
        F.coalesce(F.col("tot_benes") - F.col("_before"), F.col("tot_benes")).alias("monthly_new_benes"),
    )


def numbered(mart: DataFrame, *order: str) -> DataFrame:
    """A mart with its 1-based position ``pos``; marts are bounded, so one window partition is."""
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return mart.withColumn("pos", F.row_number().over(w).cast("bigint")).orderBy("pos")

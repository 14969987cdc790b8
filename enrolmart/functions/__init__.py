"""Scalar column expressions."""

from enrolmart.functions.expr import (  # noqa: F401
    NUMERIC_PATTERN,
    coerce_double,
    coerce_double_sql,
    finite_sql,
    format_count,
    format_rate,
    lower_columns,
    millions_label,
    month_no,
    month_no_sql,
    parse_double_sql,
    pct1,
    pct1_sql,
    report_date,
    report_date_sql,
    signed_thousands_label,
    whole_millions_label,
)

"""Scalar column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.schemas import MONTHS, RATE_TYPE

# --- fixed values -----------------------------------------------------------
# A string is numeric when it is an optionally signed decimal number with an
# optional exponent, surrounded by optional blanks.  Anything else ('', '*',
# '1,234', '-', 'NaN', 'inf', '12d', '12f') coerces to NULL.
NUMERIC_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# ---------------------------------------------------------------------------

# Spark evaluates the pattern without a regex: a string made only of digits,
# '.', '+', '-', 'e', 'E' and blanks parses as a double exactly when it
# matches the pattern (the double grammar restricted to that alphabet is the
# pattern), and every other string the double parser accepts ('NaN',
# 'Infinity', '12d', '12f', hex forms) has a character outside the alphabet.
# So "alphabet check, then try_cast" equals "pattern match, then cast", at a
# fraction of the per-cell cost.  (The oracle evaluates the pattern itself;
# a property test checks the equivalence.)
_ALPHABET_CHARS = "0123456789.+-eE \t\n\x0b\f\r"  # digits, signs, point, exponent, blanks

# Rates are computed on an exact decimal before rounding, so ties round half
# away from zero on the decimal value, not on the binary double.
_RATE_WORK_TYPE = "decimal(18,6)"


def parse_double_sql(name: str) -> str:
    """SQL text: column ``name`` as a double if it matches the pattern; too large ones are infinite."""
    return (
        f"CASE WHEN translate(`{name}`, '{_ALPHABET_CHARS}', '') = '' "
        f"THEN try_cast(`{name}` AS DOUBLE) END"
    )


def finite_sql(value: str) -> str:
    """SQL text: a count is never infinite, what overflowed (``1e400``) is NULL."""
    return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} END"


def coerce_double_sql(name: str) -> str:
    """SQL text of ``coerce_double`` for column ``name``."""
    return finite_sql(f"({parse_double_sql(name)})")


def coerce_double(c: str) -> Column:
    """String -> double; values not matching NUMERIC_PATTERN become NULL, the row is kept."""
    return F.expr(coerce_double_sql(c))


def month_no_sql(month: str) -> str:
    """SQL text: full English month name -> 1..12; anything else (incl. 'Year') -> NULL.

    Exact, case-sensitive match, like a CASE over the twelve names.
    """
    whens = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(MONTHS, start=1))
    return f"(CASE {month} {whens} END)"


def report_date_sql(year: str, month: str) -> str:
    """SQL text: first day of the month; NULL when the month is not a month name."""
    return f"make_date(CAST({year} AS INT), {month_no_sql(month)}, 1)"


def pct1_sql(part: str, whole: str) -> str:
    """SQL text: share in percent, one decimal, rounded on an exact numeric."""
    return (
        f"CAST(round(CAST({part} / nullif({whole}, 0D) * 100D AS {_RATE_WORK_TYPE}), 1) "
        f"AS {RATE_TYPE.simpleString()})"
    )


def _name(c: Column | str) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def month_no(month: str) -> Column:
    """Full English month name -> 1..12; anything else (incl. 'Year') -> NULL."""
    return F.expr(month_no_sql(_name(month)))


def report_date(year: str, month: str) -> Column:
    """First day of the month; NULL when the month is not a month name."""
    return F.expr(report_date_sql(_name(year), _name(month)))


def pct1(part: str, whole: str) -> Column:
    """Share in percent rounded to one decimal on an exact numeric."""
    return F.expr(pct1_sql(_name(part), _name(whole)))


def format_count(c: Column | str) -> Column:
    """'1,234,568' style: thousands separators, no decimals."""
    return F.format_number(F.col(c) if isinstance(c, str) else c, 0)


def format_rate(c: Column | str) -> Column:
    """'54.3%' for a one-decimal rate."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(c.cast(RATE_TYPE).cast("string"), F.lit("%"))


def millions_label(c: str, digits: int) -> Column:
    """'65.4M' style: a count in millions with ``digits`` decimals."""
    return F.concat(F.format_string(f"%.{digits}f", F.col(c) / 1e6), F.lit("M"))


def signed_thousands_label(c: str) -> Column:
    """'+125K' style: a change in thousands, rounded, always signed."""
    label = F.concat(F.format_string("%+.0f", F.col(c) / 1e3), F.lit("K"))
    return F.when(F.col(c).isNotNull(), label)


def whole_millions_label(c: str) -> Column:
    """'65M' style: a count in millions, cut to the whole number (axis ticks)."""
    return F.concat((F.col(c) / 1e6).cast("bigint").cast("string"), F.lit("M"))


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name (one projection)."""
    return df.toDF(*[c.lower() for c in df.columns])

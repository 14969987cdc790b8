"""Relation contracts: raw release, staging and the two marts.

Every relation in the package has exactly one ``StructType`` here; nothing
is inferred at read time.  Order matters: the raw layout is positional when
a warehouse bulk-copies Parquet, so column positions are part of the
contract checked by ``quality.contract``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the upstream dataset's layout -----------------
# Dimension columns of a raw release, in order.
DIMENSIONS = (
    "year",
    "month",
    "bene_geo_lvl",
    "bene_state_abrvtn",
    "bene_state_desc",
    "bene_county_desc",
    "bene_fips_cd",
)

# The 53 measure columns of a raw release, in order.
MEASURES = (
    "tot_benes",
    "orgnl_mdcr_benes",
    "ma_and_oth_benes",
    "aged_tot_benes",
    "aged_esrd_benes",
    "aged_no_esrd_benes",
    "dsbld_tot_benes",
    "dsbld_esrd_and_esrd_only_benes",
    "dsbld_no_esrd_benes",
    "male_tot_benes",
    "female_tot_benes",
    "white_tot_benes",
    "black_tot_benes",
    "api_tot_benes",
    "hspnc_tot_benes",
    "natind_tot_benes",
    "othr_tot_benes",
    "age_lt_25_benes",
    "age_25_to_44_benes",
    "age_45_to_64_benes",
    "age_65_to_69_benes",
    "age_70_to_74_benes",
    "age_75_to_79_benes",
    "age_80_to_84_benes",
    "age_85_to_89_benes",
    "age_90_to_94_benes",
    "age_gt_94_benes",
    "dual_tot_benes",
    "full_dual_tot_benes",
    "part_dual_tot_benes",
    "nodual_tot_benes",
    "qmb_only_benes",
    "qmb_plus_benes",
    "slmb_only_benes",
    "slmb_plus_benes",
    "qdwi_qi_benes",
    "othr_full_dual_mdcd_benes",
    "a_b_tot_benes",
    "a_b_orgnl_mdcr_benes",
    "a_b_ma_and_oth_benes",
    "a_tot_benes",
    "a_orgnl_mdcr_benes",
    "a_ma_and_oth_benes",
    "b_tot_benes",
    "b_orgnl_mdcr_benes",
    "b_ma_and_oth_benes",
    "prscrptn_drug_tot_benes",
    "prscrptn_drug_pdp_benes",
    "prscrptn_drug_mapd_benes",
    "prscrptn_drug_deemed_eligible_full_lis_benes",
    "prscrptn_drug_full_lis_benes",
    "prscrptn_drug_partial_lis_benes",
    "prscrptn_drug_no_lis_benes",
)

# Warehouse VARCHAR limits of the dimension columns.
VARCHAR_LIMITS = {
    "year": 10,
    "month": 10,
    "bene_geo_lvl": 50,
    "bene_state_abrvtn": 2,
    "bene_state_desc": 100,
    "bene_county_desc": 100,
    "bene_fips_cd": 5,
}

# Month names, January first; the annual summary row uses ANNUAL_MONTH.
MONTHS = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)
ANNUAL_MONTH = "Year"

# Geography levels accepted in staging.
GEO_LEVELS = ("National", "State", "County")

# State code that the by-state mart leaves out (unknown state).
UNKNOWN_STATE = "UK"

# Natural key of a raw row.
RAW_KEY = ("year", "month", "bene_geo_lvl", "bene_state_abrvtn", "bene_county_desc")

# Race measures in stacking order, with display labels.
RACE_SERIES = (
    ("white_tot_benes", "White"),
    ("black_tot_benes", "Black"),
    ("api_tot_benes", "Asian/Pacific Islander"),
    ("hspnc_tot_benes", "Hispanic"),
    ("natind_tot_benes", "Native American/Alaska Native"),
    ("othr_tot_benes", "Other"),
)

# Program measures in stacking order, with display labels.
PROGRAM_SERIES = (
    ("orgnl_mdcr_benes", "Original Medicare"),
    ("ma_and_oth_benes", "MA and Other"),
)
# ---------------------------------------------------------------------------

# Staging renames: raw column -> staging column (year is also cast to int).
STG_RENAMES = (
    ("year", "year"),
    ("month", "month"),
    ("bene_geo_lvl", "bene_geo_lvl"),
    ("bene_state_abrvtn", "state"),
    ("bene_state_desc", "state_name"),
    ("bene_county_desc", "county"),
    ("bene_fips_cd", "fips_code"),
    ("tot_benes", "total_beneficiaries"),
    ("orgnl_mdcr_benes", "original_medicare_benes"),
    ("ma_and_oth_benes", "medicare_advantage_benes"),
    ("aged_tot_benes", "aged_beneficiaries"),
    ("dsbld_tot_benes", "disabled_beneficiaries"),
    ("male_tot_benes", "male_beneficiaries"),
    ("female_tot_benes", "female_beneficiaries"),
)

STG_MEASURES = tuple(new for _, new in STG_RENAMES[7:])

RATE_TYPE = T.DecimalType(18, 1)


def _struct(fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Landed release: every value is a string, column names as published (upper case).
LANDED = _struct([(c.upper(), T.StringType()) for c in DIMENSIONS + MEASURES])

# Typed raw release: dimensions stay strings, measures become doubles.
RAW = _struct(
    [(c, T.StringType()) for c in DIMENSIONS] + [(c, T.DoubleType()) for c in MEASURES]
)

STG = _struct(
    [
        ("year", T.IntegerType()),
        ("month", T.StringType()),
        ("bene_geo_lvl", T.StringType()),
        ("state", T.StringType()),
        ("state_name", T.StringType()),
        ("county", T.StringType()),
        ("fips_code", T.StringType()),
    ]
    + [(c, T.DoubleType()) for c in STG_MEASURES]
)

NATIONAL = _struct(
    [("report_date", T.DateType())]
    + [(c, T.DoubleType()) for c in STG_MEASURES]
    + [
        ("ma_penetration_rate", RATE_TYPE),
        ("ffs_penetration_rate", RATE_TYPE),
        ("year", T.IntegerType()),
        ("month", T.StringType()),
    ]
)

BY_STATE = _struct(
    [
        ("year", T.IntegerType()),
        ("state", T.StringType()),
        ("state_name", T.StringType()),
        ("fips_code", T.StringType()),
    ]
    + [(c, T.DoubleType()) for c in STG_MEASURES]
    + [("ma_penetration_rate", RATE_TYPE), ("ffs_penetration_rate", RATE_TYPE)]
)

CONTRACTS = {
    "raw": RAW,
    "stg": STG,
    "national": NATIONAL,
    "by_state": BY_STATE,
}

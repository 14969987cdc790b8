"""Test scaffolding: derive an enrollment-shaped raw release from the star schema.

The public enrollment data is not available offline, so the driver's
``orders`` and ``customer`` tables stand in:

* y = year(o_orderdate), m = month of o_orderdate, k = c_nationkey ("state"),
  g = c_mktsegment ("county"), ok = o_orderkey, st = o_orderstatus;
* levels come from the grouping sets ((y,m),(y),(y,m,k),(y,k),(y,m,k,g),(y,k,g)):
  no month -> the annual 'Year' row; no k -> National; no g -> State; else County;
* each measure counts base rows meeting a condition; County cells below 3 are
  suppressed as '*', so numeric coercion has something to do.

Plan shape (scale): the join output is aggregated once at the finest grain
(y, m, k, g) with map-side partial aggregation, so the shuffle carries at most
one row per (task, fine group).  The six grouping sets are then rolled up from
that small relation instead of expanding every order row six times.  The join
strategy is left to AQE: it broadcasts customer only when the runtime size
check passes and otherwise keeps a sort-merge join, whose hot keys it splits
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from enrolmart.schemas import MEASURES, MONTHS, UNKNOWN_STATE

# --- fixed values: measure conditions over ok (order key) and st (status) ---
# Each entry is (measure, SQL predicate); the predicates are plain SQL that
# both Spark and the DuckDB oracle evaluate.
MEASURE_CONDITIONS = (
    ("tot_benes", "true"),
    ("orgnl_mdcr_benes", "st = 'F'"),
    ("ma_and_oth_benes", "st <> 'F'"),
    ("aged_tot_benes", "ok % 5 <> 0"),
    ("aged_esrd_benes", "ok % 5 <> 0 AND ok % 50 = 1"),
    ("aged_no_esrd_benes", "ok % 5 <> 0 AND ok % 50 <> 1"),
    ("dsbld_tot_benes", "ok % 5 = 0"),
    ("dsbld_esrd_and_esrd_only_benes", "ok % 50 = 0"),
    ("dsbld_no_esrd_benes", "ok % 5 = 0 AND ok % 50 <> 0"),
    ("male_tot_benes", "ok % 2 = 0"),
    ("female_tot_benes", "ok % 2 <> 0"),
    ("white_tot_benes", "ok % 6 = 0"),
    ("black_tot_benes", "ok % 6 = 1"),
    ("api_tot_benes", "ok % 6 = 2"),
    ("hspnc_tot_benes", "ok % 6 = 3"),
    ("natind_tot_benes", "ok % 6 = 4"),
    ("othr_tot_benes", "ok % 6 = 5"),
    ("age_lt_25_benes", "ok % 10 = 0"),
    ("age_25_to_44_benes", "ok % 10 = 1"),
    ("age_45_to_64_benes", "ok % 10 = 2"),
    ("age_65_to_69_benes", "ok % 10 = 3"),
    ("age_70_to_74_benes", "ok % 10 = 4"),
    ("age_75_to_79_benes", "ok % 10 = 5"),
    ("age_80_to_84_benes", "ok % 10 = 6"),
    ("age_85_to_89_benes", "ok % 10 = 7"),
    ("age_90_to_94_benes", "ok % 10 = 8"),
    ("age_gt_94_benes", "ok % 10 = 9"),
    ("dual_tot_benes", "ok % 4 = 0"),
    ("full_dual_tot_benes", "ok % 8 = 0"),
    ("part_dual_tot_benes", "ok % 8 = 4"),
    ("nodual_tot_benes", "ok % 4 <> 0"),
    ("qmb_only_benes", "ok % 24 = 4"),
    ("qmb_plus_benes", "ok % 24 = 0"),
    ("slmb_only_benes", "ok % 24 = 12"),
    ("slmb_plus_benes", "ok % 24 = 8"),
    ("qdwi_qi_benes", "ok % 24 = 20"),
    ("othr_full_dual_mdcd_benes", "ok % 24 = 16"),
    ("a_b_tot_benes", "ok % 10 < 8"),
    ("a_b_orgnl_mdcr_benes", "ok % 10 < 8 AND st = 'F'"),
    ("a_b_ma_and_oth_benes", "ok % 10 < 8 AND st <> 'F'"),
    ("a_tot_benes", "ok % 10 < 9"),
    ("a_orgnl_mdcr_benes", "ok % 10 < 9 AND st = 'F'"),
    ("a_ma_and_oth_benes", "ok % 10 < 9 AND st <> 'F'"),
    ("b_tot_benes", "ok % 10 <> 8"),
    ("b_orgnl_mdcr_benes", "ok % 10 <> 8 AND st = 'F'"),
    ("b_ma_and_oth_benes", "ok % 10 <> 8 AND st <> 'F'"),
    ("prscrptn_drug_tot_benes", "ok % 3 <> 0"),
    ("prscrptn_drug_pdp_benes", "ok % 3 = 1"),
    ("prscrptn_drug_mapd_benes", "ok % 3 = 2"),
    ("prscrptn_drug_deemed_eligible_full_lis_benes", "ok % 12 IN (1, 2)"),
    ("prscrptn_drug_full_lis_benes", "ok % 12 IN (4, 5)"),
    ("prscrptn_drug_partial_lis_benes", "ok % 12 IN (7, 8)"),
    ("prscrptn_drug_no_lis_benes", "ok % 12 IN (10, 11)"),
)
# Nation key that plays the unknown state, and the County suppression floor.
UNKNOWN_NATION_KEY = 24
SUPPRESS_BELOW = 3
# ---------------------------------------------------------------------------

assert tuple(m for m, _ in MEASURE_CONDITIONS) == MEASURES

GROUPING_SETS = (("y", "m"), ("y",), ("y", "m", "k"), ("y", "k"), ("y", "m", "k", "g"), ("y", "k", "g"))


# Columns of the two star-schema tables the adapter reads (a pruned,
# explicit read schema: no footer inference on the driver).
ORDERS_COLUMNS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
    ]
)
CUSTOMER_COLUMNS = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its calendar month, nation and segment."""
    orders = read_table(spark, sf_dir, "orders", ORDERS_COLUMNS)
    customer = read_table(spark, sf_dir, "customer", CUSTOMER_COLUMNS)
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.selectExpr(
        "year(o_orderdate) AS y",
        "month(o_orderdate) AS m",
        "c_nationkey AS k",
        "c_mktsegment AS g",
        "o_orderkey AS ok",
        "o_orderstatus AS st",
    )


def rolled_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure counts for every grouping set, plus grouping flags gm, gk, gg.

    Written as SQL text over the base DataFrame: 53 conditional counts are
    parsed once on the JVM instead of being assembled call by call.
    """
    counts = ", ".join(
        f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS {name}" for name, cond in MEASURE_CONDITIONS
    )
    sums = ", ".join(f"sum({name}) AS {name}" for name in MEASURES)
    sets = ", ".join("(" + ", ".join(s) + ")" for s in GROUPING_SETS)
    return spark.sql(
        f"SELECT y, m, k, g, grouping(m) AS gm, grouping(k) AS gk, grouping(g) AS gg, {sums} "
        f"FROM (SELECT y, m, k, g, {counts} FROM {{base}} GROUP BY y, m, k, g) "
        f"GROUP BY GROUPING SETS ({sets})",
        base=base(spark, sf_dir),
    )


_MONTH_ARRAY = "array(" + ", ".join(f"'{m}'" for m in MONTHS) + ")"


def landed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw release as landed: 60 string columns, lower-case names."""
    dims = [
        "CAST(y AS STRING) AS year",
        f"CASE WHEN gm = 1 THEN 'Year' ELSE element_at({_MONTH_ARRAY}, m) END AS month",
        "CASE WHEN gk = 1 THEN 'National' WHEN gg = 1 THEN 'State' ELSE 'County' END AS bene_geo_lvl",
        f"CASE WHEN gk = 1 THEN 'US' WHEN k = {UNKNOWN_NATION_KEY} THEN '{UNKNOWN_STATE}' "
        "ELSE concat('A', char(k + 65)) END AS bene_state_abrvtn",
        "CASE WHEN gk = 1 THEN 'National' ELSE concat('STATE_', CAST(k AS STRING)) END AS bene_state_desc",
        "CASE WHEN gg = 1 THEN 'Total' ELSE g END AS bene_county_desc",
        "CASE WHEN gk = 1 THEN '00000' ELSE lpad(CAST(k AS STRING), 5, '0') END AS bene_fips_cd",
    ]
    measures = [
        f"CASE WHEN gg = 0 AND {m} < {SUPPRESS_BELOW} THEN '*' ELSE CAST({m} AS STRING) END AS {m}"
        for m in MEASURES
    ]
    return rolled_counts(spark, sf_dir).selectExpr(*dims, *measures)


# ---------------------------------------------------------------------------
# The same recipe as DuckDB SQL (the oracle side).  It is written as a single
# GROUPING SETS aggregation over the join, an independent plan from the
# two-phase Spark one above.
# ---------------------------------------------------------------------------


def landed_raw_sql() -> str:
    counts = ",\n    ".join(
        f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in MEASURE_CONDITIONS
    )
    measures = ",\n    ".join(
        f"CASE WHEN gg = 0 AND {m} < {SUPPRESS_BELOW} THEN '*' ELSE CAST({m} AS VARCHAR) END AS {m}"
        for m in MEASURES
    )
    sets = ", ".join("(" + ", ".join(s) + ")" for s in GROUPING_SETS)
    return f"""
b AS (
  SELECT year(o.o_orderdate) AS y, month(o.o_orderdate) AS m, c.c_nationkey AS k,
         c.c_mktsegment AS g, o.o_orderkey AS ok, o.o_orderstatus AS st
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
rolled AS (
  SELECT y, m, k, g, grouping(m) AS gm, grouping(k) AS gk, grouping(g) AS gg,
    {counts}
  FROM b GROUP BY GROUPING SETS ({sets})
),
landed AS (
  SELECT CAST(y AS VARCHAR) AS year,
    CASE WHEN gm = 1 THEN 'Year' ELSE monthname(make_date(2000, m, 1)) END AS month,
    CASE WHEN gk = 1 THEN 'National' WHEN gg = 1 THEN 'State' ELSE 'County' END AS bene_geo_lvl,
    CASE WHEN gk = 1 THEN 'US' WHEN k = {UNKNOWN_NATION_KEY} THEN '{UNKNOWN_STATE}'
         ELSE 'A' || chr(65 + k) END AS bene_state_abrvtn,
    CASE WHEN gk = 1 THEN 'National' ELSE 'STATE_' || CAST(k AS VARCHAR) END AS bene_state_desc,
    CASE WHEN gg = 1 THEN 'Total' ELSE g END AS bene_county_desc,
    CASE WHEN gk = 1 THEN '00000' ELSE lpad(CAST(k AS VARCHAR), 5, '0') END AS bene_fips_cd,
    {measures}
  FROM rolled
)"""

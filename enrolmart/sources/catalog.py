"""Views in the catalog over a stored release, for every session that shares it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from enrolmart.operators.staging import STRICT_YEAR
from enrolmart.schemas import RAW, STG_RENAMES
from enrolmart.sources.writers import full_reload


def stg_sql(table: str) -> str:
    """The staging layer as SQL over a raw table."""
    columns = [f"{STRICT_YEAR if src == 'year' else f'`{src}`'} AS `{dst}`" for src, dst in STG_RENAMES]
    return f"SELECT {', '.join(columns)} FROM {table}"


def create_views(spark: SparkSession, raw: DataFrame, name: str, location: str) -> dict[str, str]:
    """Store the raw relation as a table and put the staging and level views over it.

    Returns layer -> name.  A view holds no rows: filters and columns asked of
    it reach the scan of the table, and a reload of the table shows at once.
    """
    names = {layer: f"{name}_{layer}" for layer in ("raw", "stg", "monthly", "annual")}
    full_reload(spark, raw, names["raw"], location, RAW)
    spark.sql(f"CREATE OR REPLACE VIEW {names['stg']} AS {stg_sql(names['raw'])}")
    for layer, annual in (("monthly", "<>"), ("annual", "=")):
        spark.sql(
            f"CREATE OR REPLACE VIEW {names[layer]} AS SELECT * FROM {names['stg']} WHERE month {annual} 'Year'"
        )
    return names


def drop_views(spark: SparkSession, names: dict[str, str]) -> None:
    for layer in ("monthly", "annual", "stg"):
        spark.sql(f"DROP VIEW IF EXISTS {names[layer]}")
    spark.sql(f"DROP TABLE IF EXISTS {names['raw']}")

"""Landings as published: every page one file that holds a JSON array of records.

Records carry no page field; a page's offset is in its path, either of a file
``page-<offset>.json`` or of a folder ``page_offset=<offset>``.  The download
ends with an empty page.  A page that does not parse is kept whole in a
quarantine and never becomes rows of NULLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrolmart.operators.ordering import with_position
from enrolmart.operators.profile import sql_str, stack_sql
from enrolmart.schemas import LANDED, RAW_KEY
from enrolmart.sources.readers import PAGE_COL

# The text of a record (or page, or CSV line) that does not parse.
BROKEN_COL = "broken_text"
_BROKEN_FLAG = "is_broken"
_OFFSET = rf"(?:{PAGE_COL}=|page-)([0-9]+)(?:/[^/]*|[^/0-9][^/]*)?$"
MAX_PAGES = 500


def _file_offset(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, _OFFSET, 1), F.lit("")).try_cast("bigint")


def _with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(BROKEN_COL, T.StringType(), True)])


def land_page_files(
    landed: DataFrame, path: str, page_size: int = 5000, order: list[Column] | None = None
) -> None:
    """Land a release as page files: arrays of ``page_size`` records, and the empty page that ends them.

    A page is the only unit that is gathered (its size is the parameter);
    positions come from a distributed order.
    """
    order = order or [F.col(c).asc_nulls_last() for c in RAW_KEY]
    record = F.struct(*[F.col(c).alias(c.upper()) for c in landed.columns])
    offset = F.floor((F.col("_pos") - 1) / page_size) * page_size
    pages = (
        with_position(landed, order, "_pos")
        .select(offset.cast("bigint").alias(PAGE_COL), F.struct("_pos", record.alias("r")).alias("x"))
        .groupBy(PAGE_COL)
        .agg(F.array_sort(F.collect_list("x")).alias("xs"))
    )
    text = F.to_json(F.col("xs.r"), {"ignoreNullFields": "false", "pretty": "true"})
    write_pages(pages.select(PAGE_COL, text.alias("value")), path)
    total = with_end(page_files(landed.sparkSession, path))
    total.write.partitionBy(PAGE_COL).mode("append").text(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Write (page_offset, value) rows as one file per page."""
    pages.write.partitionBy(PAGE_COL).mode("overwrite").text(path)


def with_end(found: DataFrame) -> DataFrame:
    """The empty page after the pages found: (page_offset, value), one row."""
    end = F.coalesce(F.max(F.col(PAGE_COL) + F.col("n_rows")), F.lit(0))
    return found.agg(end.cast("bigint").alias(PAGE_COL)).withColumn("value", F.lit("[]"))


def page_records(spark: SparkSession, path: str, schema: T.StructType = LANDED) -> DataFrame:
    """Records of all pages with their page's offset and file; a broken page is one row with its text."""
    read = (
        spark.read.schema(_with_broken(schema))
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", BROKEN_COL)
        .json(path)
    )
    file = F.col("_metadata.file_path")
    return read.select("*", _file_offset(file).alias(PAGE_COL), file.alias("file"))


def line_records(spark: SparkSession, path: str, schema: T.StructType = LANDED) -> DataFrame:
    """Records of a landing with one record per line; a broken line is one row with its text."""
    read = (
        spark.read.schema(_with_broken(schema)).option("columnNameOfCorruptRecord", BROKEN_COL).json(path)
    )
    return read.select("*", F.col("_metadata.file_path").alias("file"))


def csv_records(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Rows of a CSV; a line with other cells than the schema has, or cells of other types, is broken."""
    read = (
        spark.read.schema(_with_broken(schema))
        .option("columnNameOfCorruptRecord", BROKEN_COL)
        .option("header", header)
        .csv(path)
    )
    return read.select("*", F.col("_metadata.file_path").alias("file"))


@dataclass(frozen=True)
class Ingested:
    """What a landing gave: good rows, quarantined texts, and their numbers."""

    good: DataFrame
    broken: DataFrame
    n_good: int
    n_broken: int


def quarantine(records: DataFrame, target: str, max_broken: int | None = None) -> Ingested:
    """Write good rows and broken texts side by side under ``target``, parsed and counted in one pass.

    More than ``max_broken`` broken texts are an error (after the write, so
    they can be looked at).
    """
    spark = records.sparkSession
    flag = F.col(BROKEN_COL).isNotNull()
    seen = Observation()
    rows = records.withColumn(_BROKEN_FLAG, flag)
    rows.observe(
        seen, F.count_if(~F.col(_BROKEN_FLAG)).alias("good"), F.count_if(F.col(_BROKEN_FLAG)).alias("broken")
    ).write.partitionBy(_BROKEN_FLAG).parquet(target)
    counts = seen.get
    if max_broken is not None and counts["broken"] > max_broken:
        raise ValueError(f"{counts['broken']} broken records under {target}, at most {max_broken} allowed")
    stored = spark.read.schema(rows.schema).parquet(target)
    good = stored.where(~F.col(_BROKEN_FLAG)).drop(_BROKEN_FLAG, BROKEN_COL)
    broken = stored.where(_BROKEN_FLAG).select(
        *[c for c in (PAGE_COL, "file") if c in records.columns], BROKEN_COL
    )
    return Ingested(good, broken, counts["good"], counts["broken"])


def page_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_offset, value): every page file as one text (a page is bounded by its size)."""
    whole = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    file = F.col("_metadata.file_path")
    return whole.select(file.alias("file"), _file_offset(file).alias(PAGE_COL), "value")


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """Per page file: (file, page_offset, n_rows, broken, ends), the empty page that ends the download too.

    The array's length is NULL for a text that does not parse to its end.
    """
    size = F.when(F.regexp_like("value", F.lit(r"\]\s*$")), F.json_array_length("value"))
    return page_texts(spark, path).withColumn("n", size).select(
        "file",
        PAGE_COL,
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"),
        F.col("n").isNull().alias("broken"),
        F.coalesce(F.col("n") == 0, F.lit(False)).alias("ends"),
    )


def page_faults(spark: SparkSession, path: str) -> DataFrame:
    """Per page file: (page_offset, n_rows, fault), fault NULL for a page that is in its place.

    ``no offset``: the path tells none; ``broken``: it does not parse;
    ``twice``: another file has this offset; ``gap``: it is not the first
    and no page ends where it begins.
    """
    pages = page_files(spark, path)
    at = pages.groupBy(PAGE_COL).agg(F.count(F.lit(1)).alias("_files"))
    ends = pages.where("n_rows > 0").select((F.col(PAGE_COL) + F.col("n_rows")).alias("_end")).distinct()
    fault = (
        F.when(F.col(PAGE_COL).isNull(), "no offset")
        .when(F.col("broken"), "broken")
        .when(F.col("_files") > 1, "twice")
        .when((F.col(PAGE_COL) != 0) & F.col("_end").isNull(), "gap")
    )
    return (
        pages.join(at, PAGE_COL, "left")
        .join(ends, F.col(PAGE_COL) == F.col("_end"), "left")
        .select(PAGE_COL, "n_rows", fault.alias("fault"), "ends")
    )


def require_pages(spark: SparkSession, path: str, max_pages: int = MAX_PAGES) -> int:
    """The number of records of a whole landing; an error for any fault or a download that did not end."""
    found = page_faults(spark, path)
    told = found.agg(
        F.count_if(F.col("fault").isNotNull()).alias("faults"),
        F.count_if(F.col("ends")).alias("ends"),
        F.count_if(F.col("n_rows") > 0).alias("pages"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("records"),
    ).first()
    if told.faults:
        some = [(r[PAGE_COL], r.fault) for r in found.where("fault IS NOT NULL").orderBy(PAGE_COL).limit(10).collect()]
        raise ValueError(f"{told.faults} faulty pages of {path}: {some}")
    if not told.ends:
        raise ValueError(f"{path} has no empty page: its download did not end")
    if told.pages >= max_pages:
        raise ValueError(f"{path} reached the limit of {max_pages} pages")
    return told.records


def record_texts(spark: SparkSession, path: str, pages: bool) -> DataFrame:
    """One JSON text per record, of page files or of lines."""
    if not pages:
        return spark.read.text(path).select(F.col("value").alias("record"))
    return page_texts(spark, path).select(F.explode(F.from_json("value", "array<string>")).alias("record"))


def schema_drift(
    texts: DataFrame, relation: str, expected: dict[str, str], unexpected: str = "warn"
) -> DataFrame:
    """(check, column_name, drift, severity): keys of the records against the expected ones.

    ``absent``: no record has the key; ``always_null``: records have it, none
    a value; ``unexpected``: a key that is not expected.  ``expected`` gives
    the severity by name.  Records share few sets of keys, so keys are grouped
    as sets first; values are counted in one aggregate.
    """
    spark = texts.sparkSession
    keys = (
        texts.groupBy(F.json_object_keys("record").alias("keys"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode("keys").alias("column_name"))
        .distinct()
    )
    names = list(expected)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    parsed = texts.select(F.from_json("record", schema).alias("r")).select("r.*")
    wide = parsed.selectExpr(*[f"count(`{c}`) AS _{i}" for i, c in enumerate(names)])
    told = wide.selectExpr(
        stack_sql(
            [(sql_str(c), f"_{i}", sql_str(expected[c])) for i, c in enumerate(names)],
            ["column_name", "_values", "_severity"],
        )
    )
    drift = (
        F.when(~F.col("_there"), "absent")
        .when(F.col("_values").isNull(), "unexpected")
        .when(F.col("_values") == 0, "always_null")
    )
    both = told.join(keys.withColumn("_there", F.lit(True)), "column_name", "full")
    both = both.withColumn("_there", F.coalesce("_there", F.lit(False)))
    severity = F.when(F.col("_there"), F.lit(unexpected)).otherwise(F.col("_severity"))
    return (
        both.withColumn("drift", drift)
        .where(F.col("drift").isNotNull())
        .select(F.lit(f"{relation}.schema_drift").alias("check"), "column_name", "drift", severity.alias("severity"))
    )

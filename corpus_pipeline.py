"""The corpus pipeline: documents through five operators of ``enrolmart.llm``.

Toxic documents are rejected, repeated line chunks removed, one document of
each group of near copies kept, contaminated documents dropped, and the rest
packed into token sequences.  Each stage reads all that the one before wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrolmart.llm import decontam, line_dedup, packing, simhash, toxicity
from enrolmart.llm.common import staged, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    fitted = toxicity.model(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, fitted)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shortened texts; n_chars follows the text where lines went."""
    out = line_dedup.dedup(docs)
    n_chars = F.when(F.col("__removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).drop("__lines", "__removed")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The fingerprints' hash, the classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if name == STAGES[-1][0] else staged(out, f"pipeline-{name}")
    return docs

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from enrolmart.session import scratch_dir

# The letters that the contracts fold (ASCII only).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and odd characters included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty text."""
    return df.select(
        col(id_col).cast("long").alias("doc_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and go on from the files.

    Cuts the lineage, so lost executors cost no recomputation of earlier
    stages, and several readers see the same rows.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition: equal on ``names``, null equal to null."""
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once per row however often body uses it.

    A plain column that a lambda refers to may be inlined there by the
    optimizer and then evaluated once per element.
    """
    return F.transform(F.array(value), body)[0]


def map_rows(df: DataFrame, run) -> DataFrame:
    """``mapInArrow`` over whole rows, whatever the columns are called (run sees them by place)."""
    from pyspark.sql import types as T

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.schema.fields])
    return plain.mapInArrow(run, out).toDF(*df.columns)


_ZSTD = "zstd"


def packed(rows: np.ndarray) -> bytes:
    """Whole numbers by byte place, compressed."""
    return pa.compress(np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 8).T).tobytes(), _ZSTD, asbytes=True)


def unpacked(raw: bytes, count: int) -> np.ndarray:
    plain = np.frombuffer(pa.decompress(raw, 8 * count, _ZSTD), np.uint8)
    return np.ascontiguousarray(plain.reshape(8, count).T).view(np.int64).ravel()

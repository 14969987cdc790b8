"""Exact dedup: documents grouped by a 128-bit content hash, compared byte by byte.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` became
one space.  The hash is the first half of the SHA-256 of that text.

* Distinct (hash, text) pairs are formed with map-side combine, so a text is
  compared with the bytes of all texts of its hash, and copies meet before
  they travel.  A hash with several texts is split into one group per text.
* The group table (smallest id, size) is small; the rows find their group by
  hash.  Groups with a share of at least 1 / ``HOT`` of all rows, at most
  ``HOT`` of them, are broadcast, so no key of the join is common.

Defined cases: a null text is the empty text; a null id sorts after all other
ids (a group of null ids keeps one of them); of rows that are equal in id and
text exactly one stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm.common import col, id_text, null_safe, staged

SPACES = r"[\x20\x09-\x0D]+"
HOT = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def content_key(text: Column) -> Column:
    """128 bits of the text's SHA-256."""
    return F.unhex(F.left(F.sha2(text, 256), F.lit(32)))


def _texts(docs: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, text, h): normalised texts and their hashes."""
    rows = id_text(docs, id_col, text_col).withColumn("text", normalised(F.col("text")))
    return rows.withColumn("h", key(F.col("text")))


def _clashes(rows: DataFrame) -> DataFrame | None:
    """(h, text, part): the texts of every hash that stands for several, numbered from 1; None if there is none."""
    texts = rows.select("h", "text").distinct()
    several = staged(texts.groupBy("h").count().where("count > 1").select("h"), "exact-clashes")
    if several.isEmpty():
        return None
    found = texts.join(several, "h", "left_semi")
    number = F.row_number().over(Window.partitionBy("h").orderBy("text"))
    return staged(found.withColumn("part", number), "exact-parts")


def mark(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Callable[[Column], Column] = content_key
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _texts(docs, id_col, text_col, key)
    clashes = _clashes(rows)
    part = F.lit(0)
    if clashes is not None:
        rows = rows.join(clashes, ["h", "text"], "left")
        part = F.coalesce("part", F.lit(0))
    # Row numbers are written with the rows, so both readers below see the same ones.
    rows = staged(
        rows.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            "h",
            part.alias("part"),
            F.sha2("text", 256).alias("text_sha256"),
        ),
        "exact-rows",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = staged(
        rows.groupBy("h", "part")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("h", "part", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"),
        "exact-groups",
    )
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    is_hot = (F.col("group_size") > 1) & (F.col("group_size") * HOT >= total)
    # At most HOT groups hold a share of 1 / HOT.
    hot, rest = F.broadcast(groups.where(is_hot)), groups.where(~is_hot)
    on = ["h", "part"]
    found = rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(rest, on))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Callable[[Column], Column] = content_key
) -> DataFrame:
    """The documents that stay, with all their columns.

    Of rows that are equal in id and text, any one stays.
    """
    id_name, sha_name = "__exact_id", "__exact_sha"
    text = normalised(F.coalesce(col(text_col).cast("string"), F.lit("")))
    rows = docs.withColumns({id_name: col(id_col).cast("long"), sha_name: F.sha2(text, 256)})
    kept = mark(docs, id_col, text_col, key).where("kept").select(
        F.col("doc_id").alias(id_name), F.col("text_sha256").alias(sha_name)
    )
    one = rows.dropDuplicates([id_name, sha_name])
    return one.join(kept, null_safe(one, kept, id_name, sha_name), "left_semi").drop(id_name, sha_name)


def op11(docs: DataFrame) -> DataFrame:
    return mark(docs)


SQL = r"""
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed by a rolling (polynomial) hash; of
every ``window`` consecutive hashes the smallest is chosen, the rightmost of
equals, and its position is kept.  So two texts that share a run of at least
``window + k - 1`` code points share a fingerprint hash, whatever surrounds
it.  A text shorter than ``k`` has one run, itself; one with fewer than
``window`` runs has one window.  The empty text has no fingerprint.

``fingerprints``  text form (``hash@position`` in order) per document.
``likeness``      shared share of two fingerprints' hashes (Jaccard), 1 for
                  two empty ones.
``successors``    walks documents in descending id order and hands each its
                  successor, with one shuffle of the texts and no global sort
                  in one task.

Defined cases: a null text is empty; ids that repeat are ordered by their
texts; null ids come last; the successor of the last document is the first
(of a single one, itself); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import id_text

K = 16
WINDOW = 64
# Windows handled at a time (bounds memory for long texts).
_CHUNK = 1 << 18
_TEXTS = 256


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all runs of k codes (by doubling the run length)."""
    factor = 0x9E3779B97F4A7C15
    run, size = codes.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while True:
        if k & size:
            whole = run if whole is None else whole[: len(run) - done] * np.uint64(
                pow(factor, size, 1 << 64)
            ) + run[done:]
            done += size
        if done == k:
            break
        run = run[:-size] * np.uint64(pow(factor, size, 1 << 64)) + run[size:]
        size *= 2
    whole = whole[: len(codes) - k + 1]
    whole = (whole ^ (whole >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (whole ^ (whole >> np.uint64(33))) >> np.uint64(32)


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    size = 1
    n = len(keys) - window + 1
    while size * 2 <= window:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return keys[:n] if size == window else np.minimum(keys[:n], keys[window - size :])


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, len(codes))
    window = min(window, len(codes) - k + 1)
    last = np.uint64(0xFFFFFFFF)
    chosen = []
    for first in range(0, len(codes) - k - window + 2, _CHUNK):
        h = _hashes(codes[first : first + _CHUNK + window + k - 2], k)
        # Ties go to the right: a later position makes a smaller key.
        place = last - np.arange(first, first + len(h), dtype=np.uint64)
        m = _window_minima(h << np.uint64(32) | place, window)
        chosen.append(m[np.concatenate(([True], m[1:] != m[:-1]))])
    m = np.concatenate(chosen)
    m = m[np.concatenate(([True], m[1:] != m[:-1]))]
    return m >> np.uint64(32), (last - (m & last)).astype(np.int64)


def as_text(chosen: tuple[np.ndarray, np.ndarray]) -> str:
    return " ".join(["%08x@%d" % x for x in zip(chosen[0].tolist(), chosen[1].tolist())])


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def fingerprints(
    docs: DataFrame, k: int = K, window: int = WINDOW, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, fingerprint) per row."""

    def run(batches):
        for b in batches:
            prints = [as_text(winnow(t, k, window)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"]
            )

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, guest, doc_id, text): ids in descending ranges, and each range's following text.

    Ranges come from approximate quantiles of the ids.  The rows that open
    the next range are sent to the range before it as well, as guests.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("doc_id", shares or [0.5], 10_000)).first()[0] or []
    bounds = np.unique(np.array(found if shares else [], np.int64))

    @F.pandas_udf("int")
    def rank(ids: pd.Series) -> pd.Series:
        # The number of bounds above the id: the largest ids are in range 0.
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), "right"))

    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        rank(F.coalesce("doc_id", F.lit(0)))
    )
    placed = docs.withColumn("bucket", bucket)
    tops = (
        placed.groupBy("bucket").agg(F.max("doc_id").alias("top")).orderBy("bucket").collect()
    )  # at most ``buckets`` + 1 rows
    if not tops:
        return placed.select("bucket", F.lit(False).alias("guest"), "doc_id", "text")
    before = {t["top"]: tops[i - 1]["bucket"] for i, t in enumerate(tops) if t["top"] is not None}
    host = F.lit(None).cast("int")
    if before:
        hosts = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
        host = F.try_element_at(hosts, F.col("doc_id")).cast("int")
    places = F.array(
        F.struct(F.col("bucket"), F.lit(False).alias("guest")),
        F.struct(host.alias("bucket"), F.lit(True).alias("guest")),
    )
    out = placed.select(F.explode(places).alias("p"), "doc_id", "text").where(
        "p.bucket is not null"
    )
    out = out.select("p.bucket", "p.guest", "doc_id", "text")
    if tops[-1]["top"] is None:  # documents without id: the first by text opens their range
        opener = (
            docs.where("doc_id is null")
            .groupBy("doc_id")
            .agg(F.min("text").alias("text"))
            .select(F.lit(tops[-2 if len(tops) > 1 else -1]["bucket"]).alias("bucket"),
                    F.lit(True).alias("guest"), "doc_id", "text")
        )
        out = out.union(opener)
    return out


def successors(docs: DataFrame, visit, schema: str, buckets: int | None = None) -> DataFrame:
    """Rows of ``visit(doc_id, text, next_text, memo) -> (row, memo)`` over (doc_id, text).

    ``memo`` is what the call for the document before returned about its
    successor (None at first): it saves looking at a text twice.
    """
    # Several ranges a partition: the hash that deals them out evens their sizes.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(docs, buckets or 8 * partitions)
    names = [x.split()[0] for x in schema.split(", ")]
    types = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    arrow = pa.schema([(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")])

    def run(batches):
        held, rows, memo = None, [], None  # held: (bucket, doc_id, text) waiting for its successor

        def out():
            cols = list(zip(*rows)) or [()] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow
            )

        for b in batches:
            for i in range(0, b.num_rows, _TEXTS):
                part = b.slice(i, _TEXTS)
                for bucket, guest, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    if held and held[0] == bucket:
                        row, memo = visit(held[1], held[2], text, memo)
                        rows.append(row)
                    else:
                        memo = None
                    held = None if guest else (bucket, doc_id, text)
                yield out()

    return (
        dealt.repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text")
        .mapInArrow(run, schema)
    )


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_edited(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint against its edited text's and its successor's."""

    def visit(doc_id, text, following, memo):
        own = memo or winnow(text, k, window)
        after = winnow(following, k, window)
        n = len(text)
        edited = text[: n - n // 3] + following[: n // 3]
        changed = winnow(edited, k, window)
        sets = [set(x[0].tolist()) for x in (own, changed, after)]
        row = (
            doc_id,
            n,
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            as_text(own),
            as_text(changed),
            likeness(sets[0], sets[1]),
            likeness(sets[0], sets[2]),
        )
        return row, after

    return successors(id_text(docs), visit, COMPARED)


def op10(docs: DataFrame) -> DataFrame:
    return compare_edited(docs)

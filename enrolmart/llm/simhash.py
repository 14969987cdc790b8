"""SimHash near-dedup: 64-bit fingerprints joined by a binary trie.

``fingerprints``  one 64-bit SimHash per document.
``links``         pairs of fingerprints at most ``max_bits`` apart, as a
                  spanning set (every link lies inside the components that
                  the returned pairs connect).
``near_dups``     doc_id, fingerprint, component_id.

Documents with the same fingerprint are merged before the join, so a group
of exact copies of any size is one trie leaf.  The trie is dealt out over
the cluster by the pigeonhole rule: of b blocks of bits, two fingerprints
that differ in m bits agree in at least b - m blocks, so for every choice
of b - m blocks the fingerprints are grouped by those blocks' bits and each
group's subtrie is joined with itself.  b grows with the number of distinct
fingerprints, which keeps groups of evenly spread ones small.  Groups that
are larger all the same (templates that agree in many bits) are split by the
same rule over the bits that their mask leaves, until none has more than
``_LARGEST`` rows: distinct fingerprints that differ in few bits are few.

Inside a group, node pairs are traversed together, differing bits are
accumulated, and a pair is pruned as soon as it exceeds the error budget or
when all leaves of both nodes are already connected; so a dense cluster of
near copies costs about its size rather than all its pairs.

Defined cases: null and empty texts (no words) have fingerprint zero and
link like any other; texts of fewer than ``shingle`` words have one shingle;
repeated rows get equal results; the component of documents whose ids are
all null is null; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import col, id_text, staged

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# Rows of the bit matrix counted at a time (bounds memory for long texts).
_BIT_ROWS = 1 << 15
# Node pairs with at most this many leaf pairs are compared leaf by leaf.
_LEAF_PAIRS = 64
# Node pairs handled at a time.
_FRONTIER = 1 << 18
# Fingerprints of complete groups that are joined together in one call.
_BATCH = 1 << 17
# Groups are kept to about this many uniformly spread fingerprints.
_GROUP = 512
# Groups with more fingerprints are split (at most 1 << 15 fit in 15 free bits).
_LARGEST = 1 << 15
# Keys that hold more than this share of all rows are answered by broadcast, so at most so many.
_HOT_KEYS = 100_000


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: a bit is 1 if set in over half the shingles' hashes."""
    import xxhash

    words = raw.lower().split()  # bytes: folds and splits at ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = [xxhash.xxh64_digest(joined, SEED)]
    else:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lens + 1) - 1
        starts = (ends - lens)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_digest
        digests = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    n = len(digests)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _BIT_ROWS):
        part = np.frombuffer(b"".join(digests[i : i + _BIT_ROWS]), np.uint8)
        counts += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_md5, fp): one row per input row."""

    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fps = pa.array([simhash(t, shingle) for t in texts], pa.int64())
            columns = [b.column("doc_id"), b.column("text_md5"), fps]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_md5", "fp"])

    texts = id_text(docs, id_col, text_col).withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    return texts.mapInArrow(run, "doc_id long, text_md5 string, fp long")


def _unite(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Connect u[i] with v[i]; parent[i] is the smallest index of i's component."""
    while True:
        a, b = parent[u], parent[v]
        apart = a != b
        if not apart.any():
            return parent
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _leaf_pairs(a_lo, a_n, b_lo, b_n, same):
    """All leaf pairs of the node pairs; of a node with itself, each pair once."""
    n = a_n * b_n
    at = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = a_lo[at] + k // b_n[at], b_lo[at] + k % b_n[at]
    keep = ~same[at] | (i < j)
    return i[keep], j[keep]


def trie_join(fps: np.ndarray, bounds: np.ndarray, max_bits: int) -> np.ndarray:
    """Component labels within groups ``fps[bounds[g]:bounds[g + 1]]`` (each sorted, distinct).

    Returns parent: parent[i] is the smallest index connected with i through
    pairs of its group that differ in at most ``max_bits`` bits.
    """
    parent = np.arange(len(fps))
    lo, hi = bounds[:-1], bounds[1:]
    lo, hi = lo[hi - lo > 1], hi[hi - lo > 1]
    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, a_lo, a_hi, b_lo, b_hi, dist = stack.pop()
        if len(a_lo) > _FRONTIER:
            half = len(a_lo) // 2
            stack.append((bit, *(x[half:] for x in (a_lo, a_hi, b_lo, b_hi, dist))))
            a_lo, a_hi, b_lo, b_hi, dist = (x[:half] for x in (a_lo, a_hi, b_lo, b_hi, dist))
        # Prune node pairs whose leaves are all in one component already.
        change = np.concatenate(([0], np.cumsum(parent[1:] != parent[:-1])))
        done = (
            (change[a_lo] == change[a_hi - 1])
            & (change[b_lo] == change[b_hi - 1])
            & (parent[a_lo] == parent[b_lo])
            & ((a_lo != b_lo) | (a_hi - a_lo > 1))
        )
        keep = ~done
        a_lo, a_hi, b_lo, b_hi, dist = (x[keep] for x in (a_lo, a_hi, b_lo, b_hi, dist))
        a_n, b_n, same = a_hi - a_lo, b_hi - b_lo, a_lo == b_lo
        small = (a_n * b_n <= _LEAF_PAIRS) | (bit < 0)
        if small.any():
            i, j = _leaf_pairs(a_lo[small], a_n[small], b_lo[small], b_n[small], same[small])
            near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
            parent = _unite(parent, i[near], j[near])
            big = ~small
            a_lo, a_hi, b_lo, b_hi, dist, same = (
                x[big] for x in (a_lo, a_hi, b_lo, b_hi, dist, same)
            )
        if not len(a_lo):
            continue
        ones = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1)))).astype(
            np.int64
        )
        a_mid, b_mid = a_hi - (ones[a_hi] - ones[a_lo]), b_hi - (ones[b_hi] - ones[b_lo])
        pairs = [
            (a_lo, a_mid, b_lo, b_mid, dist),
            (a_mid, a_hi, b_mid, b_hi, dist),
            (a_lo, a_mid, b_mid, b_hi, dist + 1),
            tuple(x[~same] for x in (a_mid, a_hi, b_lo, b_mid, dist + 1)),
        ]
        merged = [np.concatenate(x) for x in zip(*pairs)]
        a_lo, a_hi, b_lo, b_hi, dist = merged
        keep = (a_hi > a_lo) & (b_hi > b_lo) & (dist <= max_bits)
        keep &= (a_lo != b_lo) | (a_hi - a_lo > 1)
        if keep.any():
            # Pairs of a node with itself last: they are popped first and
            # connect dense clusters before their cross pairs are looked at.
            a_lo, a_hi, b_lo, b_hi, dist = (x[keep] for x in merged)
            own = a_lo == b_lo
            for part in (~own, own):
                if part.any():
                    stack.append((bit - 1, *(x[part] for x in (a_lo, a_hi, b_lo, b_hi, dist))))
    return parent


def masks(n: int, max_bits: int) -> list[int]:
    """Bit masks of the block choices: every pair within max_bits agrees under one of them."""
    blocks = max_bits + 1
    while True:
        edges = [64 * i // blocks for i in range(blocks + 1)]
        sizes = sorted(b - a for a, b in zip(edges, edges[1:]))
        if n >> sum(sizes[: blocks - max_bits]) <= _GROUP or blocks >= max_bits + 4:
            break
        blocks += 1
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(part[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer(mask: int, max_bits: int) -> list[int]:
    """``mask`` with one of max_bits + 1 parts of the bits that it leaves out, for each part.

    Two values that agree under ``mask`` and differ in at most max_bits bits
    agree under one of the results, as one of the parts holds no differing bit.
    """
    free = [i for i in range(64) if not mask >> i & 1]
    parts = [free[i :: max_bits + 1] for i in range(max_bits + 1)]
    return [mask | sum(1 << i for i in part) for part in parts if part] or [mask]


def groups(distinct: DataFrame, max_bits: int, total: int, largest: int | None = None) -> DataFrame:
    """(mask, k, fp): groups of at most ``largest`` rows; pairs within max_bits share one.

    ``largest`` is at least 1 << max_bits: a larger group differs in more
    than max_bits bits, so that none of ``finer``'s parts is empty.
    """
    largest = max(largest or _LARGEST, 1 << max_bits)
    first = F.explode(F.array(*[F.lit(_signed(m)) for m in masks(total, max_bits)]))
    keyed = distinct.select("fp", first.alias("mask"))
    keyed, done = keyed.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("k"), "fp"), None
    while True:
        sizes = keyed.groupBy("mask", "k").agg(F.count(F.lit(1)).alias("n"))
        hot = staged(sizes.where(F.col("n") > largest).select("mask", "k"), "hot-groups")
        found = [r["mask"] for r in hot.select("mask").distinct().collect()]  # not the groups
        if not found:
            return keyed if done is None else done.union(keyed)
        small = keyed.join(hot, ["mask", "k"], "left_anti")
        done = small if done is None else done.union(small)
        # Every round fixes more bits: groups with none left hold one fingerprint.
        table = distinct.sparkSession.createDataFrame(
            [(m, _signed(f)) for m in found for f in finer(m % (1 << 64), max_bits)],
            "mask long, finer long",
        )
        split = (
            keyed.join(hot, ["mask", "k"], "left_semi")
            .join(F.broadcast(table), "mask")  # max_bits + 1 rows a mask
            .select(
                F.col("finer").alias("mask"),
                F.col("fp").bitwiseAND(F.col("finer")).alias("k"),
                "fp",
            )
        )
        # Different masks may be refined to the same one.
        keyed = staged(split.distinct(), "split-groups")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, total: int | None = None) -> DataFrame:
    """(a, b): a spanning set of the pairs of distinct ``fp`` at most max_bits apart."""
    keyed = groups(distinct, max_bits, distinct.count() if total is None else total)
    # The trie's order is that of the unsigned value: flip the sign bit to sort.
    order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))

    def run(batches):
        held = np.zeros((0, 3), np.int64)

        def join(rows):
            t, k, fp = rows.T
            start = np.flatnonzero(
                np.concatenate(([True], (t[1:] != t[:-1]) | (k[1:] != k[:-1])))
            )
            fps = np.ascontiguousarray(fp).view(np.uint64)
            parent = trie_join(fps, np.append(start, len(fps)), max_bits)
            at = np.flatnonzero(parent != np.arange(len(fps)))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[at]), pa.array(fp[parent[at]])], ["a", "b"]
            )

        for b in batches:
            held = np.vstack([held, np.column_stack([c.to_numpy() for c in b.columns])])
            if len(held) >= _BATCH:
                last = (held[:, :2] != held[-1, :2]).any(axis=1).nonzero()[0]
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield join(held[:cut])
                    held = held[cut:]
        if len(held):
            yield join(held)

    return (
        keyed.repartition("mask", "k")
        .sortWithinPartitions("mask", "k", order)
        .mapInArrow(run, "a long, b long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, by alternating stars.

    Large-star links every larger neighbour to the smallest one, small-star
    every smaller neighbour; repeated until nothing changes, which takes a
    number of rounds logarithmic in the size of the largest component.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = staged(e, "links"), None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(m, "u")
            .select(
                F.explode(
                    F.array(
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                        F.struct(F.col("u"), F.col("m").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        e = staged(small, "links")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_dups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_md5, fp, component_id, root) per row.

    component_id is the smallest linked doc_id; root, the smallest linked
    fingerprint, names a component even where ids are null.
    """
    fps = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rows = F.count(F.lit(1)).alias("n")
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), rows), "classes")
    total = classes.count()
    roots = components(links(classes.select("fp"), max_bits, total))
    root = F.coalesce("root", "fp").alias("root")  # the smallest of a component is no node
    rooted = classes.join(roots, classes.fp == roots.node, "left")
    rooted = staged(rooted.select("fp", "rep", F.col("n").alias("rows"), root), "rooted")
    ids = staged(rooted.groupBy("root").agg(F.min("rep").alias("component_id"), rows), "components")
    named = join_dealt(rooted, ids, "root", total)
    named = named.select("fp", F.col("rows").alias("n"), "component_id", "root")
    out = join_dealt(fps, staged(named, "named"), "fp")
    return out.select("doc_id", "text_md5", "fp", "component_id", "root")


def join_dealt(rows: DataFrame, named: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """``rows`` joined with ``named``, which has every key once and in ``n`` its number of rows.

    Keys of more than 1 / _HOT_KEYS of all rows, hence at most _HOT_KEYS of
    them, are broadcast, so that no key's rows meet in one task; the others
    are joined as usual.
    """
    if total is None:
        total = named.agg(F.sum("n")).first()[0] or 0
    least = max(_GROUP, total // _HOT_KEYS)
    hot = F.broadcast(named.where(F.col("n") > least).drop("n"))
    cold = named.where(F.col("n") <= least).drop("n")
    rest = rows.join(hot.select(key), key, "left_anti")
    both = rows.join(hot, key)
    return both.union(rest.join(cold, key).select(*both.columns))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: one row of each component stays.

    It is the row with the smallest doc_id (null ids last), then the smallest
    text hash; of rows equal in both, the one with the smallest row hash.
    """
    found = near_dups(docs, shingle, max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_md5"))
    kept = found.groupBy("root").agg(first.alias("k")).select("k.doc_id", "k.text_md5")
    again = (
        found.groupBy("doc_id", "text_md5")
        .agg(F.count(F.lit(1)).alias("__n"))
        .join(kept.withColumnsRenamed({"doc_id": "__id", "text_md5": "__md5"}),
              F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_md5") == F.col("__md5")))
        .select("__id", "__md5", "__n")
    )
    md5 = F.md5(F.coalesce(col("text").cast("string"), F.lit("")).cast("binary"))
    whole = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"),
        col("doc_id").cast("long").alias("__doc"),
        md5.alias("__text"),
    )
    out = whole.join(
        again, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__md5"))
    )
    once = out.where("__n = 1").select("row.*")
    more = (
        out.where("__n > 1")
        .groupBy("__doc", "__text")
        .agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        .select("row.*")
    )
    return once.union(more)


def op9(docs: DataFrame) -> DataFrame:
    return near_dups(docs).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )

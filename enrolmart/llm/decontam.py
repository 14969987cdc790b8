"""Benchmark decontamination: test n-grams broadcast as a hash set, documents scanned once.

Words are runs of ASCII letters and digits (letters folded) and of any
non-ASCII characters.  Every ``window`` consecutive words of a benchmark item
are a window (an item of fewer words, but not none, is one window).  The
windows' rolling hashes are broadcast; each task slides the same hash over
the words of its documents, and every hash hit is verified word by word.

The broadcast is checked: a benchmark of more than ``max_bytes`` is split
into blocks of that size, every block is scanned for in turn, and the word
spans it hits are united per document.

Defined cases: a null text has no words, and neither has a text without word
characters; such items match nothing and such documents are not
contaminated; a null item id is written as the empty string; items with equal
ids count once; repeated documents get equal results; an empty benchmark
contaminates nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm.common import col, map_rows, staged

WINDOW = 13
# A document is contaminated if at least one word in CONTAMINATED is hit.
CONTAMINATED = 20
MAX_BYTES = 32 << 20
_TEXTS = 512
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
# Bytes of words (folded); every other byte separates.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)


def words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_FOLD).split()


class Matcher:
    """The windows of a set of items [(id text, words)], by length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for name, ws in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                owners[size][tuple(ids[i : i + size])].add(place[name])
        windows_of = {size: np.array(list(of), np.int64) for size, of in owners.items()}
        rng = np.random.default_rng(0)
        while True:  # new values for the words until no two windows share a hash
            self.value = self._values(rng, len(self.vocabulary) + 1)
            hashes_of = {n: self._hash(self.value[w.T]) for n, w in windows_of.items()}
            if all(len(np.unique(h)) == len(h) for h in hashes_of.values()):
                break
        self.sizes = []  # (size, sorted hashes, windows, owners' offsets, owners)
        for size, of in owners.items():
            windows, hashes = windows_of[size], hashes_of[size]
            order = np.argsort(hashes)
            own = [sorted(x) for x in of.values()]
            own = [own[i] for i in order]
            self.sizes.append(
                (
                    size,
                    hashes[order],
                    windows[order],
                    np.concatenate(([0], np.cumsum([len(x) for x in own]))),
                    np.fromiter(chain.from_iterable(own), np.int64),
                )
            )

    @staticmethod
    def _values(rng, n: int) -> np.ndarray:
        return rng.integers(1, 1 << 63, n, np.uint64)

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = np.zeros_like(columns[0])
        for c in columns:
            total = total * np.uint64(0x9E3779B97F4A7C15) + c
        return total

    def match(self, texts: list[bytes | None]):
        """Per text: its number of words, a hit mask over them, and its items' places."""
        split = [words(t) for t in texts]
        lens = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(lens + 1)  # a zero (unknown word) follows each text
        starts = ends - lens - 1
        get = self.vocabulary.get
        ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        keep = np.ones(len(ids), bool)
        keep[ends - 1] = False
        ids[keep] = np.fromiter(
            map(get, chain.from_iterable(split), repeat(0)), np.int64, int(lens.sum())
        )
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        edge = np.zeros(len(ids) + 1, np.int64)
        pairs = []
        for size, hashes, windows, offsets, own in self.sizes:
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            found = self._hash([self.value[ids[at + j]] for j in range(size)])
            w = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            same = hashes[w] == found
            at, w = at[same], w[same]
            exact = (ids[at[:, None] + np.arange(size)] == windows[w]).all(axis=1)
            at, w = at[exact], w[exact]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + size, -1)
            doc = np.searchsorted(ends, at, "right")
            n = offsets[w + 1] - offsets[w]
            k = np.arange(n.sum()) + np.repeat(offsets[w] - np.cumsum(n) + n, n)
            pairs.append(np.unique(np.repeat(doc, n) * len(self.names) + own[k]))
        hit = np.cumsum(edge[:-1]) > 0
        items: dict[int, list[int]] = defaultdict(list)
        if pairs:
            for p in np.unique(np.concatenate(pairs)).tolist():
                items[p // len(self.names)].append(p % len(self.names))
        for d, (s, n) in enumerate(zip(starts.tolist(), lens.tolist())):
            yield n, hit[s : s + n], items.get(d, ())


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_bytes: int):
    """Item lists of at most about ``max_bytes`` of text each."""
    items = benchmark.select(
        F.coalesce(col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 16)).first()[0] or 0
    n = -(-size // max_bytes)
    if n <= 1:
        yield items.collect()
        return
    items = staged(items, "benchmark")
    for b in range(n):
        yield items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()


def _matchers(docs, benchmark, window, item_col, text_col, max_bytes):
    sc = docs.sparkSession.sparkContext
    for block in _blocks(benchmark, item_col, text_col, max_bytes):
        m = Matcher([(r["item"], words(r["text"].encode())) for r in block], window)
        yield sc.broadcast((vars(m),))


def _matched(shared, texts):
    m = Matcher.__new__(Matcher)
    vars(m).update(shared.value[0])
    for i in range(0, len(texts), _TEXTS):
        for n, hit, items in m.match(texts.slice(i, _TEXTS).cast(pa.binary()).to_pylist()):
            yield n, hit, [m.names[k] for k in items]


def _runs(hit: np.ndarray) -> list[dict]:
    """Runs of hit words as [start, end) word positions."""
    at = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(at[::2], at[1::2])]


SCAN = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """(doc_id, text_md5, n_words, spans of hit words, sorted items) per row."""
    slim = docs.select(
        col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text")
    ).withColumn("text_md5", F.md5(F.col("text").cast("binary")))

    def one(shared):
        def run(batches):
            for b in batches:
                rows = list(_matched(shared, b.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"),
                        b.column("text_md5"),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([_runs(r[1]) for r in rows], _SPANS),
                        pa.array([r[2] for r in rows], pa.list_(pa.string())),
                    ],
                    ["doc_id", "text_md5", "n_words", "spans", "items"],
                )

        return slim.mapInArrow(run, "doc_id long, text_md5 string, " + SCAN)

    found = [one(s) for s in _matchers(docs, benchmark, window, item_col, item_text_col, max_bytes)]
    if len(found) == 1:
        return found[0]
    # Several blocks: unite each document's spans.  Rows that repeat a document have equal
    # spans, so they are united once and joined back to every row.
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    every = staged(every, "block-hits")
    start, end = F.col("s.start"), F.col("s.end")
    w = Window.partitionBy("doc_id", "text_md5").orderBy(start, end)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        every.select("doc_id", "text_md5", F.explode("spans").alias("s"))
        .distinct()
        .withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
        .where(end > F.col("reach"))
        .select("doc_id", "text_md5", F.greatest(start, "reach").alias("start"), end.alias("end"))
        .groupBy("doc_id", "text_md5")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    items = (
        every.select("doc_id", "text_md5", F.explode("items").alias("item"))
        .groupBy("doc_id", "text_md5")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    rows = slim.select("doc_id", "text_md5").alias("r")
    words_of = every.select("doc_id", "text_md5", "n_words").distinct()
    for part in (words_of, spans, items):
        right = part.withColumnsRenamed({"doc_id": "__id", "text_md5": "__md5"})
        rows = rows.join(
            right,
            F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("text_md5").eqNullSafe(F.col("__md5")),
            "left",
        ).drop("__id", "__md5")
    none = "array<struct<start:long,end:long>>"
    return rows.select(
        "doc_id",
        "text_md5",
        "n_words",
        F.coalesce("spans", F.array().cast(none)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(hit, n_words):
    return (hit > 0) & (hit * CONTAMINATED >= n_words)


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    mode: str = "documents",
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """``docs`` without its contaminated documents, or (mode "spans") without their hit spans.

    A removed span goes from its first hit word to the end of its last one.
    Nothing is shuffled: each block of the benchmark filters in one pass.
    A document that no single block contaminates, but several do together,
    is judged by the sum: blocks add up hits in a column before the last one decides.
    """
    state = "__hit_words"
    out = docs.withColumn(state, F.array().cast("array<struct<start:long,end:long>>"))
    place = docs.columns.index(text_col)

    def step(frame, shared, last):
        def run(batches):
            for b in batches:
                texts, keep, held, cut = b.column(place), [], [], []
                before = b.column(b.num_columns - 1).to_pylist()
                for i, (n, hit, _) in enumerate(_matched(shared, texts)):
                    for s in before[i]:
                        hit = hit.copy()
                        hit[s["start"] : s["end"]] = True
                    held.append(_runs(hit))
                    h = int(hit.sum())
                    bad = last and h > 0 and h * CONTAMINATED >= n
                    keep.append(not bad or mode == "spans")
                    if bad and mode == "spans":
                        cut.append((i, held[-1]))
                columns = [*b.columns[:-1], pa.array(held, _SPANS)]
                if cut:
                    new = texts.to_pylist()
                    for i, spans in cut:
                        new[i] = _without(new[i], spans)
                    columns[place] = pa.array(new, texts.type)
                got = pa.RecordBatch.from_arrays(columns, names=b.schema.names)
                yield got.filter(pa.array(keep))

        return map_rows(frame, run)

    matchers = list(_matchers(docs, benchmark, window, item_col, item_text_col, max_bytes))
    for k, shared in enumerate(matchers):
        out = step(out, shared, k == len(matchers) - 1)
    return out.drop(state)


def _without(text: str, spans: list[dict]) -> str:
    places = [m.span() for m in _WORD.finditer(text)]
    kept, at = [], 0
    for s in spans:
        kept.append(text[at : places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    return "".join(kept) + text[at:]


def op4(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = scan(docs, benchmark).withColumn("n_hit", n_hit(F.col("spans")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


# Fixed value: what separates words (the contract's character class, negated).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"list_filter(regexp_split_to_array({_FOLDED}, '{SEPARATORS}'), lambda x: x <> '')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS n,
         array_to_string(list_slice(w, i, i + least({WINDOW}, len(w)) - 1), ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW} + 2, 2))) AS i FROM b WHERE len(w) > 0)
),
place AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT d.doc_id, d.w, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM win) s WHERE len(d.w) >= s.n)
),
hits AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win USING (n, g)),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
              FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {CONTAMINATED} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

"""Source divergence audit by single-pass in-memory indexing.

Every language keeps the terms in at least ``min_docs`` of its documents.  A
(language, source) group gives each of them a smoothed share in billionths,
``p = 1 + floor(1e9 * (count + 2) / (N + 2 * V))``, and the divergence of two
shares is ``floor((p - q)^2 / (p + q))``.  All arithmetic is exact.

1. *Blocks.*  A task builds postings (language, term, source: occurrences,
   documents) in memory until ``block`` of them are there, writes them out as
   a run sorted by term, and goes on with an empty index.
2. *Merge.*  The runs are dealt to hash shards of (language, term).  Each
   shard is sorted, which in Spark merges sorted, spilled runs through a heap,
   and read as a stream: one row per term with its sources' frequencies.
   No task holds more than one term's postings and a batch.
3. *Pair corrections.*  A pair of sources has ``V * f(p0, q0)``, as if no term
   occurred in either.  What a term of one source changes is summed over the
   group's distinct counts; what a term of both changes beyond that is streamed
   over the postings, summed in the task, and added.

Broadcast: the groups' sizes (one row a group; the pairs in the result are their
square), up to ``MAX_GROUPS``; beyond it the query stops with an error
before any pair is formed.

Defined cases: null text, language and source are empty strings; a group
without terms has count 0 everywhere, a language without kept terms has pairs
of value 0 and no terms; repeated rows count as often as they occur; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm.common import col, staged

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SMOOTH = 2
# Postings in memory (about 300 bytes each), texts read at once.
BLOCK, _TEXTS = 400_000, 256
# Groups whose sizes are broadcast; pairs that a task sums before it hands them on, and handles at once.
MAX_GROUPS = 100_000
_PAIRS, _AT_ONCE = 1 << 21, 1 << 20

# A term is letters and what lies beyond ASCII; all other bytes become a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def _source(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    named = {"lang": lang_col, "source": source_col, "text": text_col}
    return docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])


def runs(source: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, term, source, n, docs): postings, block by block, each block's sorted by term."""

    def spill(index):
        tables = []
        for (lang, src), (counts, docs) in index.items():
            n = len(counts)
            columns = {
                "lang": pa.repeat(pa.scalar(lang, pa.string()), n),
                "term": pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                "source": pa.repeat(pa.scalar(src, pa.string()), n),
                "n": pa.array(counts.values(), pa.int64()),
                "docs": pa.array([docs[x] for x in counts], pa.int64()),
            }
            tables.append(pa.table(columns))
        index.clear()
        if tables:
            by = [(x, "ascending") for x in ("lang", "term", "source")]
            yield from pa.concat_tables(tables).sort_by(by).combine_chunks().to_batches(1 << 16)

    def run(batches):
        index, size = defaultdict(lambda: (Counter(), Counter())), 0
        for b in batches:
            for i in range(0, b.num_rows, _TEXTS):
                part = b.slice(i, _TEXTS)
                lang, src = part.column("lang").to_pylist(), part.column("source").to_pylist()
                for key, text in zip(zip(lang, src), part.column("text").cast(pa.binary()).to_pylist()):
                    found = terms(text)
                    counts, docs = index[key]
                    size -= len(counts)
                    counts.update(found)
                    docs.update(set(found))
                    size += len(counts)
                    if size >= block:
                        yield from spill(index)
                        size = 0
        yield from spill(index)

    return source.mapInArrow(run, "lang string, term string, source string, n long, docs long")


def _new(batch: pa.RecordBatch | pa.Table, *names: str) -> np.ndarray:
    """Whether a row differs from the one before it (the first does)."""
    out = np.zeros(max(batch.num_rows - 1, 0), bool)
    for name in names:
        x = batch.column(name)
        out |= pc.not_equal(x.slice(1), x.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    return np.append(True, out) if batch.num_rows else out


def merged(postings: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, sources, counts) of every kept term: frequencies by source.

    Rows arrive sorted by (lang, term, source).
    """

    def fold(rows: pa.Table):
        """Whole terms."""
        new = np.flatnonzero(_new(rows, "lang", "term", "source"))
        if not len(new):
            return
        n = np.add.reduceat(rows.column("n").to_numpy(), new)
        docs = np.add.reduceat(rows.column("docs").to_numpy(), new)
        rows = rows.take(pa.array(new))
        at = np.flatnonzero(_new(rows, "lang", "term"))
        size = np.diff(np.append(at, rows.num_rows))
        kept = np.add.reduceat(docs, at) >= min_docs
        inside = np.repeat(kept, size)
        offsets = pa.array(np.append(0, np.cumsum(size[kept])), pa.int32())
        total = np.add.reduceat(n, at)[kept]
        source = rows.column("source").filter(pa.array(inside)).combine_chunks()
        heads = rows.select(["lang", "term"]).take(pa.array(at[kept])).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [
                *(heads.column(x).combine_chunks() if heads.num_rows else pa.array([], pa.string()) for x in ("lang", "term")),
                pa.array(total),
                pa.ListArray.from_arrays(offsets, source if len(source) else pa.array([], pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(n[inside])),
            ],
            ["lang", "term", "total", "sources", "counts"],
        )

    def run(batches):
        kept = None  # the rows of the last term so far
        for b in batches:
            if not b.num_rows:
                continue
            b = pa.Table.from_batches([b])
            rows = b if kept is None else pa.concat_tables([kept, b])
            last = int(np.flatnonzero(_new(rows, "lang", "term"))[-1])
            yield from fold(rows.slice(0, last))
            kept = rows.slice(last).combine_chunks()
        if kept is not None:
            yield from fold(kept)

    dealt = postings.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    schema = "lang string, term string, total long, sources array<string>, counts array<long>"
    return dealt.mapInArrow(run, schema)


def _share(count: Column, size: Column) -> Column:
    """p of a count in a group (or language) of this size: size is N + SMOOTH * V."""
    wide = (F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.call_function("div", wide, size.cast("decimal(38,0)")) + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _distance(p: Column, q: Column) -> Column:
    # Shares are at most SCALE + 1: the square fits a long.
    return _div((p - q) * (p - q), p + q)


def shares(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """p of counts; size is N + SMOOTH * V."""
    if len(count) and count.max() + SMOOTH >= (1 << 63) // SCALE:
        return np.array([SCALE * (int(c) + SMOOTH) // int(s) + 1 for c, s in zip(count, size)], np.int64)
    return SCALE * (count + SMOOTH) // size + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _corrections(index: DataFrame, groups, pairs_held: int = _PAIRS, at_once: int = _AT_ONCE) -> DataFrame:
    """(g, h, value), g < h: sums over the terms of both of what they change beyond each group's own part.

    ``groups`` broadcasts {lang: ({source: number}, N + SMOOTH * V by place)}.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        flat: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def reduced():
            nonlocal held
            key = np.concatenate([k for k, _ in flat])
            value = np.concatenate([v for _, v in flat])
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            flat[:] = [(key[new], np.add.reduceat(value, new))]
            held = len(new)

        def out():
            nonlocal held
            if flat:
                reduced()
                key, value = flat[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(value)], ["g", "h", "value"]
                )
            flat.clear()
            held = 0

        for b in batches:
            langs = b.column("lang").to_pylist()
            counts, sources = b.column("counts"), b.column("sources")
            size = pc.list_value_length(counts).to_numpy(zero_copy_only=False)
            start = counts.offsets.to_numpy()[:-1]
            n = counts.values.to_numpy()
            names = sources.values.to_pylist()
            number = np.zeros(len(n), np.int64)
            for lang, s, m in zip(langs, start.tolist(), size.tolist()):
                known = groups.value[lang][0]
                number[s : s + m] = [known[x] for x in names[s : s + m]]
            lang_of = {}
            for i, lang in enumerate(langs):
                lang_of.setdefault(lang, []).append(i)
            for lang, rows in lang_of.items():
                whole = groups.value[lang][1]  # by number of the group within the language
                first = groups.value[lang][2]
                rows = np.array(rows)
                for m in np.unique(size[rows]).tolist():
                    if m < 2:
                        continue
                    mine = rows[size[rows] == m]
                    # Pairs of places (i, j), i < j, in parts of at most at_once pairs.
                    for i0, i1 in _blocks(m, at_once):
                        i, j = np.triu_indices(i1 - i0, 1, m - i0)
                        i, j = i + i0, j + i0
                        step = max(1, at_once // max(len(i), m))
                        for r in range(0, len(mine), step):
                            at = start[mine[r : r + step]][:, None] + np.arange(m)
                            who = number[at]
                            p = shares(n[at].ravel(), whole[who].ravel()).reshape(at.shape)
                            zero = shares(np.zeros(who.size, np.int64), whole[who].ravel()).reshape(at.shape)
                            pi, pj, zi, zj = p[:, i], p[:, j], zero[:, i], zero[:, j]
                            value = distance(pi, pj) - distance(pi, zj) - distance(zi, pj) + distance(zi, zj)
                            a, c = who[:, i] + first, who[:, j] + first
                            key = (np.minimum(a, c) << 32) | np.maximum(a, c)
                            flat.append((key.ravel(), value.ravel()))
                            held += key.size
                            if held >= pairs_held:
                                reduced()
                                if held >= pairs_held // 2:
                                    yield from out()
        yield from out()

    return index.mapInArrow(run, "g long, h long, value long").groupBy("g", "h").agg(F.sum("value").alias("value"))


def _blocks(m: int, at_once: int):
    """Ranges of places whose pairs with later places are at most at_once (or one place)."""
    step = max(1, at_once // m)
    return [(i, min(i + step, m)) for i in range(0, m, step)]


def index(docs: DataFrame, min_docs: int = MIN_DOCS, block: int = BLOCK) -> DataFrame:
    """The written index of (lang, source, text) rows."""
    return staged(merged(runs(docs, block), min_docs), "audit-index")


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    block: int = BLOCK,
) -> DataFrame:
    """lang, source, part, item, value, rank: the pairs of sources and each group's most typical terms."""
    rows = _source(docs, text_col, lang_col, source_col)
    found = index(rows, min_docs, block)
    spark = docs.sparkSession
    kept = found.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    counts = found.select(
        "lang", "term", "total", F.explode(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))).alias("x")
    ).select("lang", "term", "total", "x.source", "x.n")
    sizes = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    v, n = F.coalesce("v", F.lit(0)), F.coalesce("n", F.lit(0))
    groups = staged(
        rows.select("lang", "source")
        .distinct()
        .join(sizes, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang", "source", v.alias("v"), (n + SMOOTH * v).alias("size"),
            (F.coalesce("lang_n", F.lit(0)) + SMOOTH * v).alias("lang_size"),
        ),
        "audit-groups",
    )
    if groups.count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups of language and source")
    # At most MAX_GROUPS rows.
    listed = sorted(groups.collect(), key=lambda r: (r.lang, r.source))
    numbered = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(listed)],
        "g long, lang string, source string, v long, size long, lang_size long",
    )
    known: dict[str, tuple] = {}
    for i, r in enumerate(listed):
        known.setdefault(r.lang, ({}, [], i))
        known[r.lang][0][r.source] = len(known[r.lang][1])
        known[r.lang][1].append(r.size)
    known = {k: (names, np.array(size, np.int64), first) for k, (names, size, first) in known.items()}
    numbered = F.broadcast(numbered)
    pairs = _pairs(numbered, counts, _corrections(found, spark.sparkContext.broadcast(known)))
    terms_ = _terms(numbered, counts, top)
    return pairs.unionByName(terms_)


def _pairs(groups: DataFrame, counts: DataFrame, both: DataFrame) -> DataFrame:
    """Part ``pair``: every other source of the language, all ranks."""
    p0 = _share(F.lit(0).cast("long"), F.col("size"))
    groups_ = groups.withColumn("p0", F.when(F.col("v") > 0, p0).otherwise(0))
    a = groups_.select("lang", "g", "source", "v", "p0")
    b = groups_.select("lang", F.col("g").alias("h"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = F.when(F.col("v") > 0, F.col("v") * _distance(F.col("p0"), F.col("q0"))).otherwise(0)
    # The result's own rows.
    every = a.join(b, "lang").where("g <> h").withColumn("base", base)
    # Distinct counts of each group, with the number of terms.
    hist = (
        counts.groupBy("lang", "source", "n")
        .agg(F.count(F.lit(1)).alias("k"))
        .join(groups_.select("lang", "source", "g", "p0", "size"), ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("size")))
    )
    one = (
        hist.join(F.broadcast(b), "lang")
        .where("g <> h")
        .groupBy("g", "h")
        .agg(
            F.sum(
                F.col("k") * (_distance(F.col("p"), F.col("q0")) - _distance(F.col("p0"), F.col("q0")))
            ).alias("value")
        )
    )
    mirrored = [one, one.select(F.col("h").alias("g"), F.col("g").alias("h"), "value")]
    mirrored += [both, both.select(F.col("h").alias("g"), F.col("g").alias("h"), "value")]
    change = mirrored[0]
    for x in mirrored[1:]:
        change = change.unionByName(x)
    change = change.groupBy("g", "h").agg(F.sum("value").alias("change"))
    value = F.col("base") + F.coalesce("change", F.lit(0))
    return _ranked(
        every.join(change, ["g", "h"], "left").select(
            "lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")
        )
    )


def _terms(groups: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """Part ``term``: each group's terms that it uses more than its language, the first ``top``."""
    p, q = F.col("p"), F.col("q")
    rows = (
        counts.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("size")))
        .withColumn("q", _share(F.col("total"), F.col("lang_size")))
        .where(p > q)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _distance(p, q).alias("value"))
    )
    return _ranked(rows).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.withColumn("rank", F.row_number().over(order).cast("int"))


def op13(docs: DataFrame) -> DataFrame:
    return audit(docs)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (
  SELECT x.lang, x.source, coalesce(v.v, 0) AS v, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN v USING (lang)
), shares AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS cnt,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * g.v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), langs AS (
  SELECT kept.lang, kept.term,
         1 + 1000000000::HUGEINT * ((SELECT sum(n) FROM c WHERE c.lang = kept.lang AND c.term = kept.term)::HUGEINT + 2)
           // ((SELECT sum(n) FROM g WHERE g.lang = kept.lang) + 2 * (SELECT v FROM v WHERE v.lang = kept.lang)) AS q
  FROM kept
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows_ AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, ((s.p - q) * (s.p - q) // (s.p + q))::BIGINT
  FROM shares s JOIN langs USING (lang, term) WHERE s.cnt > 0 AND s.p > q
)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM rows_
) WHERE part = 'pair' OR rank <= 10
"""

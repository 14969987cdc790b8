"""Phrase collocation mining by SON partitioning.

Everything is per language.  A phrase is a run of 2 to ``max_words`` words
within a piece; a candidate has at least ``min_count`` occurrences.

1. Words are counted.  No candidate holds a word rarer than ``min_count``.
2. Each language is dealt into ``shards`` by ranges of document ids.  A shard is mined
   completely at the local support ``ceil(min_count / shards)``, level by
   level: pairs, then longer phrases all of whose pairs are frequent in the
   shard.  A candidate reaches the local support in some shard, else it would
   have fewer than ``min_count`` occurrences.  Mining counts 64-bit hashes: two
   phrases with one hash can only make candidates more, never fewer.
3. The union of all shards' phrases is counted over all texts, by the words
   themselves, exactly.

A shard is a key of the counts and not a task: every task mines its part of
all shards and combines before the shuffle, so no task holds a shard.  Hashes and
their counts travel in packed blocks, one for a range of about ``_PART`` tokens'
hashes, whose task adds them up.  What one step tells the next goes as a Bloom filter of at most ``MAX_BITS`` bits: beyond
the size that suits it, it lets more phrases be counted, with the same result.

Score: ``floor(2000000 * a / (l + r))`` of the cut with the lowest score
(decimals: exact at any size).  Candidates inside a longer one that is nearly
as frequent are dropped.

Defined cases: a null text is the empty text, a null language is ``und``;
repeated rows count as often as they occur; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm import tokens
from enrolmart.llm.common import col, packed, staged, unpacked
from enrolmart.llm.tokens import Tokens
from enrolmart.llm.tokens import mix as _mix

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SHARDS, MAX_SHARDS = 9, 16
# Percent of a phrase's occurrences that a longer candidate must have to replace it.
COVERED = 80
# The filters' size: bits for each entry, at most so many in all (16 MB).
BITS_EACH, MAX_BITS = 12, 1 << 27
# Tokens handled together (some 45 MB in Python; what they yield is one batch for the JVM) and,
# where only words are counted, a multiple; phrases a task counts before it hands them on.
_CHUNK, _WORDS, _FLUSH = 1 << 18, 4, 1 << 20
# Tokens for each part in which phrases' hashes are counted.
_PART = 1 << 20
# Bytes of texts for each of these tokens that are read at once.
_BYTES = 4
# Consecutive ids that go to one shard: neighbours' phrases meet in the task already.
_IDS = 1 << 12
# Parts in which a language is ranked before its first rows are ranked together.
_RANKED_IN = 64

# What ends a piece and what stands between words.
_KINDS = tokens.kinds(b" \t", b".,;:!?\n\x0b\x0c\r")


def _source(docs: DataFrame, shards: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(F.floor(col(id_col).cast("long") / _IDS)), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def word_counts(source: DataFrame, chunk: int = _WORDS * _CHUNK) -> DataFrame:
    """(lang, word, c) over all texts."""

    def run(batches):
        for x in _chunks(batches, chunk):
            word, words = x.tokens.coded()
            pair, count = np.unique((x.lang[x.doc] * len(words) + word)[x.is_word], return_counts=True)
            lang, word = np.divmod(pair, len(words))
            yield pa.RecordBatch.from_arrays(
                [x.langs.take(pa.array(lang)), words.take(pa.array(word)), pa.array(count)], ["lang", "word", "c"]
            )

    return source.mapInArrow(run, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))


def _hash(raw: bytes) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(raw))


# Odd multipliers of the filters' probes.
_PROBES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


@dataclass(frozen=True)
class Bloom:
    """A Bloom filter of 64-bit hashes; the number of bits is a power of two."""

    words: np.ndarray

    @staticmethod
    def place(keys: np.ndarray, probe: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            at = (keys * np.uint64(probe)) >> np.uint64(64 - (bits.bit_length() - 1))
        return at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for m in _PROBES:
            word, bit = self.place(keys[found], m, len(self.words) * 64)
            found[found] = (self.words[word] & bit) != 0
        return found


def bloom(rows: DataFrame, keys, count: int, max_bits: int = MAX_BITS) -> Bloom:
    """The filter of ``keys(batch)`` over all rows: tasks set bits, words of bits meet by ``bit_or``."""
    bits = 1 << 10
    while bits < min(count * BITS_EACH, max_bits):
        bits *= 2

    def run(batches):
        own = np.zeros(bits // 64, np.uint64)
        for b in batches:
            k = keys(b)
            for m in _PROBES:
                np.bitwise_or.at(own, *Bloom.place(k, m, bits))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(own[at].view(np.int64))], ["at", "word"])

    # At most bits / 64 rows.
    got = rows.mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[got.column("at").to_numpy()] = got.column("word").to_numpy().view(np.uint64)
    return Bloom(words)


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    return np.array([_hash(x.encode()) for x in langs.to_pylist()], np.uint64)


def _word_keys(b: pa.RecordBatch) -> np.ndarray:
    """Hashes of (lang, word): a phrase of one word."""
    lang = b.column("lang").dictionary_encode()
    return _mix(_lang_hashes(lang.dictionary)[lang.indices.to_numpy()], tokens.hashes(b.column("word")))


def _keys(b: pa.RecordBatch) -> np.ndarray:
    return b.column("key").to_numpy(zero_copy_only=False).view(np.uint64)


def _in_shard(h: np.ndarray, shard) -> np.ndarray:
    """Hashes with the number of the shard as their last bits."""
    return (h & ~np.uint64(MAX_SHARDS - 1)) | shard


@dataclass
class _Chunk:
    """Tokens of some texts, one after the other, each text ending with the end of a piece."""

    tokens: Tokens
    langs: pa.Array  # distinct
    lang: np.ndarray  # by text: its place in langs
    shards: np.ndarray  # by text

    @cached_property
    def doc(self) -> np.ndarray:
        return self.tokens.text

    @cached_property
    def is_word(self) -> np.ndarray:
        return self.tokens.size > 0

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.tokens.hashes()

    @cached_property
    def one(self) -> np.ndarray:
        return _mix(np.repeat(_lang_hashes(self.langs)[self.lang], self.tokens.lens), self.hashes)

    @cached_property
    def shard(self) -> np.ndarray:
        return np.repeat(self.shards, self.tokens.lens)

    def longer(self, h: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the phrases of n words from those of n - 1 that begin at the same tokens."""
        return _mix(h[: len(self.tokens) - n + 1], self.hashes[n - 1 :])

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The n words from each of these tokens on, as they stand in the buffer."""
        x, raw = self.tokens, self.tokens.raw.tobytes()
        ends = x.start[at + n - 1] + x.size[at + n - 1]
        return pa.array([raw[i:z] for i, z in zip(x.start[at].tolist(), ends.tolist())], pa.binary()).cast(pa.string())


def _chunks(batches, chunk: int):
    held, rows, size = [], [], 0

    def made():
        lang = pa.concat_arrays([b.column("lang") for b in rows]).dictionary_encode()
        shards = np.concatenate([b.column("shard").to_numpy() for b in rows])
        return _Chunk(Tokens.joined(held), lang.dictionary, lang.indices.to_numpy().astype(np.int64), shards.astype(np.uint64))

    for b in batches:
        for part in tokens.slices(b, "text", _BYTES * chunk):
            held.append(Tokens.of(part.column("text"), tokens.LOWER, _KINDS))
            rows.append(part.select(["lang", "shard"]))
            size += len(held[-1])
            if size >= chunk:
                yield made()
                held, rows, size = [], [], 0
    if held:
        yield made()


def _all(ok: np.ndarray, n: int) -> np.ndarray:
    """Whether ok holds at a place and the n - 1 after it."""
    out = ok[: max(len(ok) - n + 1, 0)].copy()
    for j in range(1, n):
        out &= ok[j : len(ok) - n + 1 + j]
    return out


def _met(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[new], np.add.reduceat(count[order], new)


def _blocks(held: list[tuple[np.ndarray, np.ndarray]], parts: int) -> pa.RecordBatch:
    """(q, size, block): keys and counts, packed by part; parts are ranges of keys."""
    key, count = _met(*(np.concatenate(x) for x in zip(*held))) if len(held) > 1 else held[0]
    q = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    ends = np.append(cuts[1:], len(q))
    rows = np.stack([key.view(np.int64), count])
    blocks = [packed(rows[:, a:z].ravel()) for a, z in zip(cuts.tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays(
        [pa.array(q[cuts].astype(np.int64)), pa.array(ends - cuts), pa.array(blocks, pa.binary())], ["q", "size", "block"]
    )


def _local_phrases(source: DataFrame, lengths: range, frequent, pairs, chunk: int, local: int, parts: int) -> DataFrame:
    """(key): the phrases of these lengths with the support ``local`` in a shard.

    ``frequent`` holds the words that may occur in them, ``pairs`` (if given)
    the pairs with the local support in their shard.
    """

    def run(batches):
        held, size = [], 0
        for x in _chunks(batches, chunk):
            ok = x.is_word.copy()
            ok[ok] = frequent.value.holds(x.one[ok])
            h = x.one
            for n in range(2, max(lengths) + 1):
                h = x.longer(h, n)
                if n == 2:
                    ok2 = _all(ok, 2)
                    if pairs is not None:
                        ok2[ok2] = pairs.value.holds(_in_shard(h[ok2], x.shard[: len(h)][ok2]))
                if n not in lengths:
                    continue
                at = np.flatnonzero(_all(ok2, n - 1))
                if not len(at):
                    continue
                held.append(np.unique(_in_shard(h[at], x.shard[at]), return_counts=True))
                size += len(held[-1][0])
            if size >= _FLUSH:
                yield _blocks(held, parts)
                held, size = [], 0
        if held:
            yield _blocks(held, parts)

    def counted(blocks: pa.Table) -> pa.Table:
        sizes = blocks.column("size").to_pylist()
        rows = [unpacked(b.as_py(), 2 * n).reshape(2, n) for n, b in zip(sizes, blocks.column("block"))]
        key, count = _met(*np.concatenate(rows, axis=1))
        return pa.table([pa.array(key[count >= local])], ["key"])

    return source.mapInArrow(run, "q long, size long, block binary").groupBy("q").applyInArrow(counted, "key long")


def _global_counts(source: DataFrame, max_words: int, candidates, chunk: int) -> DataFrame:
    """(lang, phrase, size, a) of the phrases in the filter, by their words."""

    def run(batches):
        for x in _chunks(batches, chunk):
            h, ok, words = x.one, None, x.is_word
            for n in range(2, max_words + 1):
                h = x.longer(h, n)
                # All phrases within a candidate are candidates.
                ok = _all(words, 2) if n == 2 else _all(ok, 2)
                ok[ok] = candidates.value.holds(_in_shard(h[ok], np.uint64(0)))
                at = np.flatnonzero(ok)
                if not len(at):
                    break
                order = np.argsort(h[at])
                run_ = h[at][order]
                new = np.flatnonzero(np.append(True, run_[1:] != run_[:-1]))
                count = np.diff(np.append(new, len(run_)))
                at = at[order[new]]
                yield pa.RecordBatch.from_arrays(
                    [
                        x.langs.take(pa.array(x.lang[x.doc[at]])),
                        x.phrases(at, n),
                        pa.array(np.full(len(at), n, np.int32)),
                        pa.array(count),
                    ],
                    ["lang", "phrase", "size", "a"],
                )

    counted = source.mapInArrow(run, "lang string, phrase string, size int, a long")
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))


def candidates(
    source: DataFrame,
    words: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    shards: int = SHARDS,
    max_bits: int = MAX_BITS,
    chunk: int = _CHUNK,
) -> DataFrame:
    """(lang, phrase, size, a) of every phrase with at least ``min_count`` occurrences."""
    sc = source.sparkSession.sparkContext
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"1 to {MAX_SHARDS} shards, not {shards}")
    local = -(-min_count // shards)
    common = words.where(F.col("c") >= min_count)
    tokens_, known = words.agg(F.sum("c"), F.count_if(F.col("c") >= min_count)).first()
    parts = max(1, -(-(tokens_ or 0) // _PART))
    frequent = sc.broadcast(bloom(common.select("lang", "word"), _word_keys, known, max_bits))
    pairs = staged(_local_phrases(source, range(2, 3), frequent, None, chunk, local, parts), "phrase-pairs")
    found = pairs
    if max_words > 2:
        near = sc.broadcast(bloom(pairs, _keys, pairs.count(), max_bits))
        longer = _local_phrases(source, range(3, max_words + 1), frequent, near, chunk, local, parts)
        found = pairs.unionByName(staged(longer, "phrase-longer"))
    union = found.select(F.col("key").bitwiseAND(F.lit(-MAX_SHARDS)).alias("key")).distinct()
    filter_ = sc.broadcast(bloom(union, _keys, union.count(), max_bits))
    counted = _global_counts(source, max_words, filter_, chunk)
    return staged(counted.where(F.col("a") >= min_count), "phrases")


def _decimal(c) -> Column:
    return F.col(c).cast("decimal(19,0)")


def _slice(words: str, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): each candidate's cut with the lowest score."""
    k, size = F.col("k"), F.col("size")
    cuts = (
        phrases.withColumn("w", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
        .select(
            "lang", "phrase", "a", "k",
            _slice("w", F.lit(1), k).alias("left"), _slice("w", k + 1, size - k).alias("right"),
        )
    )
    # All parts of a candidate are at least as frequent as it.
    least = phrases.agg(F.min("a")).first()[0] or 0
    parts = phrases.select("lang", "phrase", "a").unionByName(
        words.where(F.col("c") >= least).select("lang", F.col("word").alias("phrase"), F.col("c").alias("a"))
    )
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    score = F.expr("(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        cuts.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .groupBy("lang", "phrase", "a")
        .agg(lowest.alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def _inside(max_words: int) -> Column:
    """The shorter phrases, of two words or more, inside one of ``size`` words."""
    starts = [
        F.when(F.col("size") >= at + n - 1, F.when(F.col("size") > n, _slice("w", F.lit(at), F.lit(n))))
        for n in range(2, max_words)
        for at in range(1, max_words - n + 2)
    ]
    return F.array_compact(F.array(*starts))


def collocations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    shards: int = SHARDS,
    max_bits: int = MAX_BITS,
    chunk: int = _CHUNK,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` candidates."""
    source = _source(docs, shards, id_col, text_col, lang_col)
    words = staged(word_counts(source), "phrase-words")
    phrases = candidates(source, words, min_count, max_words, shards, max_bits, chunk)
    rows = scored(phrases, words)
    if max_words > 2:
        longer = (
            phrases.where("size > 2")
            .withColumn("w", F.split("phrase", " "))
            .select("lang", F.explode(_inside(max_words)).alias("phrase"), "a")
            .groupBy("lang", "phrase")
            .agg(F.max("a").alias("longer"))
        )
        covered = F.lit(100).cast("decimal(3,0)") * _decimal("longer") >= F.lit(COVERED).cast("decimal(3,0)") * _decimal("a")
        rows = rows.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~covered).drop("longer")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # Parts of a language first, so that no task ranks all of it.
    rows = rows.withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(_RANKED_IN)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order)))
    rows = rows.where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    n = words.groupBy("lang").agg(F.sum("c").alias("n"))
    return (
        rows.where(F.col("rank") <= top)
        .join(n, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def op12(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4])::INTEGER AS size) WHERE len(w) >= size
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30
), cuts AS (
  SELECT lang, phrase, a, w, size, unnest(range(1, size))::INTEGER AS k FROM c
), scores AS (
  SELECT u.lang, u.phrase, u.a, u.k, l.a AS l, r.a AS r, (2000000::HUGEINT * u.a // (l.a + r.a))::BIGINT AS score
  FROM cuts u
  JOIN f l ON l.lang = u.lang AND l.size = u.k AND l.phrase = array_to_string(u.w[1:u.k], ' ')
  JOIN f r ON r.lang = u.lang AND r.size = u.size - u.k AND r.phrase = array_to_string(u.w[u.k + 1:u.size], ' ')
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase
  FROM c, (SELECT unnest([1, 2, 3])::INTEGER AS i), (SELECT unnest([2, 3])::INTEGER AS s)
  WHERE s < size AND i + s - 1 <= size
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM inside GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM lowest x
  WHERE NOT EXISTS (SELECT 1 FROM longer y WHERE y.lang = x.lang AND y.phrase = x.phrase AND 100::HUGEINT * y.a >= 80::HUGEINT * x.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

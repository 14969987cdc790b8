"""LM scoring with a probabilistic suffix tree over word tokens.

A text is its words (ASCII letters folded) and one end token.  The tree's
root is the add-one unigram distribution over the training tokens.  A deeper
state is the one to ``depth`` tokens before the next one (the end token
before the first); never more than the text has.

* Every sequence of the training texts is a candidate, every successor of it
  counts, however rare: the tree grows with the corpus.
* A candidate is retained if the Kullback-Leibler divergence of its
  next-token distribution from that of its longest proper suffix is at least
  ``min_divergence`` (and that suffix is retained).
* Smoothing: successors are discounted by ``discount``; all others share
  the rest of the mass in proportion to the suffix state's distribution.
* Scoring uses the longest retained suffix of the tokens read so far.

States live where their sequences are.  Each token travels once, with the
tokens before it and the number of its text, in compressed blocks, to the part
of its context; a part of about ``part_tokens`` tokens counts its sequences,
tests its states level by level, scores its tokens and sends each text's sum
back.  Nothing is looked up by token.

* The word before the token chooses the part.  One with more tokens than half
  a part is dealt on by the word before it; its own state, which then
  lies in several parts, is counted first, by its distinct successors, and
  sent to them.  All longer contexts lie in one part each: a pair of words
  with a large share of all tokens is not split further.
* At most ``hot_words`` words (all those from a power of two of occurrences
  on) are broadcast with their counts and stand as numbers.  A Bloom filter of
  at most ``FILTER_BITS`` holds the other words that occur more than once: one
  that is not in it occurs here alone and needs no asking.  Each part asks for
  the counts of the rest (and of what the filter takes for them).
* What a task asks for its parts meets in packed blocks at owners, one for
  ``OWNED`` parts: a rare word's count and all pairs with it have one owner, so
  it adds pairs up, looks counts up and answers each part in one block.  The
  dealt words' own states (at most two a part) are summed and broadcast.
* Word codes have 62 bits.  Those of all words of all texts are checked to
  differ; if two do not, the next seed is drawn.

Defined cases: a null or empty text is the end token alone; a null id counts
as the empty text in the hold-out rule (not held out); repeated rows count
and score once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrolmart.llm import tokens
from enrolmart.llm.collocations import Bloom, bloom
from enrolmart.llm.common import id_text, staged
from enrolmart.llm.common import packed as _packed
from enrolmart.llm.common import unpacked as _unpacked
from enrolmart.llm.tokens import Tokens

HOT_WORDS = 1 << 20
FILTER_BITS = 1 << 27
PART_TOKENS = 1 << 20
MIN_DIVERGENCE = 0.02
DISCOUNT = 0.5
_LEAST = 1e-12
# Tokens whose words are counted together; tokens handled together; bytes of texts for each that are read at once.
_COUNTED = 1 << 20
_CHUNK = 1 << 19
_BYTES = 4
# Fixed value: what stands between words.
_KINDS = tokens.kinds(b" \t\n\x0b\x0c\r")
# What stands before the first end token of a text; numbers and codes of words are not negative.
_PAD = -1
# Words that are not broadcast have a code with this bit, above all numbers.
_RARE = 1 << 62
# In the place of a context: a word's count is told, not a sequence.
_COUNT = -2
# Parts for each owner of what parts ask; what a task asks is handed on at so many.
OWNED = 4
_ASKED = 1 << 20


def held_out(doc_id, mod: int = 7, rest: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod == rest


def _is_held_out(doc_id: str, mod: int = 7, rest: int = 2) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod == rest


def _texts(batches, chunk: int):
    """(doc ids, tokens) of about ``chunk`` tokens; the end token is the one that is no word."""
    ids, held, size = [], [], 0
    for b in batches:
        for part in tokens.slices(b, "text", _BYTES * chunk):
            ids += part.column("doc_id").to_pylist()
            held.append(Tokens.of(part.column("text"), tokens.LOWER, _KINDS))
            size += len(held[-1])
            if size >= chunk:
                yield ids, Tokens.joined(held)
                ids, held, size = [], [], 0
    if held:
        yield ids, Tokens.joined(held)


def code(words: pa.Array | Tokens, seed: int) -> np.ndarray:
    """Words' codes, of 62 bits."""
    h = words.hashes(seed) if isinstance(words, Tokens) else tokens.hashes(words, seed)
    return (h >> np.uint64(2)).view(np.int64) | _RARE


def _trained(ids: list) -> np.ndarray:
    return np.array([not held_out(i) for i in ids], bool)


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(word, code, c, m): occurrences in the training texts and in all; the end token is the empty word."""

    def run(batches):
        for ids, x in _texts(batches, _COUNTED):
            word, every = x.coded()
            m = np.bincount(word, minlength=len(every))
            c = np.bincount(word[np.repeat(_trained(ids), x.lens)], minlength=len(every))
            yield pa.RecordBatch.from_arrays([every, pa.array(c), pa.array(m)], ["word", "c", "m"])

    def coded(batches):
        for b in batches:
            codes = np.empty(b.num_rows, np.int64)
            codes[:] = code(b.column("word"), seed)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes)], ["word", "c", "m", "code"])

    counted = docs.mapInArrow(run, "word string, c long, m long").groupBy("word")
    summed = counted.agg(F.sum("c").alias("c"), F.sum("m").alias("m"))
    return summed.mapInArrow(coded, "word string, c long, m long, code long")


def distinct_codes(docs: DataFrame) -> tuple[DataFrame, int]:
    """The written word counts under the first seed that gives every word a code of its own."""
    seed = 0
    while True:
        counts = staged(word_counts(docs, seed), "lm-words")
        if counts.groupBy("code").count().where("count > 1").isEmpty():
            return counts, seed
        seed += 1


@dataclass(frozen=True)
class Shared:
    """What all tasks know: the common words by code and by number, and how words are dealt to parts."""

    codes: np.ndarray  # sorted
    number: np.ndarray  # by place in codes: most frequent first
    count: np.ndarray  # c by number
    deals: np.ndarray  # by number: among how many the tokens after this word are dealt
    total: int  # N
    types: int  # V
    parts: int
    depth: int
    seed: int
    again: Bloom  # codes of the other words that occur more than once
    least: int  # words with fewer than 2 ** least occurrences are not broadcast

    def asked(self, word: np.ndarray) -> np.ndarray:
        """Which words' counts a part must be told."""
        out = word >= _RARE
        out[out] = self.again.holds(word[out].view(np.uint64))
        return out

    def part(self, before: np.ndarray, further: np.ndarray) -> np.ndarray:
        """Parts of tokens by the word before and the one before that."""
        deals = self.dealt(before)
        h = _scramble(before) + _scramble(further) % deals
        return (_scramble(h.view(np.int64)) % np.uint64(self.parts)).astype(np.int64)

    def dealt(self, before: np.ndarray) -> np.ndarray:
        deals = np.ones(len(before), np.uint64)
        known = (before >= 0) & (before < len(self.deals))
        deals[known] = self.deals[before[known]]
        return deals

    def owner(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Who answers for b after a: rare words have one owner, pairs of common ones another each."""
        h = _scramble(b) + np.where(b < _RARE, _scramble(a), np.uint64(0))
        return (_scramble(h.view(np.int64)) % np.uint64(-(-self.parts // OWNED))).astype(np.int64)

    def root(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.total + self.types + 1))


def _scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = (x.view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return y >> np.uint64(20)


def shared(counts: DataFrame, seed: int, depth: int, hot_words: int, part_tokens: int) -> Shared | None:
    """None if there is no text."""
    exponent = F.floor(F.log2(F.col("m").cast("double"))).cast("int").alias("e")
    sizes = counts.groupBy(exponent).agg(
        F.count(F.lit(1)).alias("k"), F.sum("m").alias("m"), F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")
    )
    rows = sorted(sizes.collect(), reverse=True)  # at most 63
    if not rows:
        return None
    least, k = 63, 0
    for r in rows:
        k += r.k
        if k > hot_words:
            break
        least = r.e
    # At most hot_words rows.
    hot = counts.where(F.col("m") >= 2.0**least).select("code", "c", "m").toArrow()
    m, c, codes = (hot.column(x).to_numpy() for x in ("m", "c", "code"))
    order = np.lexsort((codes, -m))
    by_code = np.argsort(codes[order])
    tokens = sum(r.m for r in rows)
    others = counts.where((F.col("m") > 1) & (F.col("m") < 2.0**least)).select("code")
    several = sum(r.k for r in rows if r.e >= 1 and r.e < least)
    again = bloom(others, lambda b: b.column("code").to_numpy(zero_copy_only=False).view(np.uint64), several, FILTER_BITS)
    return Shared(
        codes[order][by_code],
        by_code,
        c[order],
        (m[order] // max(part_tokens // 2, 1) + 1).astype(np.uint64),
        sum(r.c for r in rows),
        sum(r.v for r in rows),
        max(1, -(-tokens // part_tokens)),
        depth,
        seed,
        again,
        least,
    )


def _keys(x: Tokens, know: Shared) -> np.ndarray:
    """Numbers (of common words) or codes of words."""
    codes = code(x, know.seed)
    order = np.argsort(codes)
    first, number = _runs(order, codes[order])
    distinct = codes[first]
    if len(know.codes):
        at = np.minimum(np.searchsorted(know.codes, distinct), len(know.codes) - 1)
        distinct = np.where(know.codes[at] == distinct, know.number[at], distinct)
    return distinct[number]


@dataclass
class _Chunk:
    """Tokens of some texts: each with the ones before it, the last one first."""

    ids: list
    lens: np.ndarray
    train: np.ndarray  # by text
    word: np.ndarray
    before: list[np.ndarray]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), self.lens)


def _chunks(batches, know: Shared, chunk: int = _CHUNK):
    depth = max(know.depth, 2)  # parts are chosen by two words
    for ids, x in _texts(batches, chunk):
        keys, n = _keys(x, know), x.lens
        # Before each text: nothing, and then one end token.
        at = np.arange(len(x)) + np.repeat(np.arange(1, len(n) + 1) * depth, n)
        arr = np.full(len(x) + len(n) * depth, _PAD, np.int64)
        arr[at] = keys
        arr[at[np.cumsum(n) - n] - 1] = keys[-1]
        yield _Chunk(ids, n, _trained(ids), keys, [arr[at - j] for j in range(1, depth + 1)])


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct row, and the number of each row's.

    Rows are sorted by a hash; if it does not tell all of them apart, by themselves.
    """
    h = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for x in columns:
            h = (h ^ x.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    order = np.argsort(h)
    first, number = _runs(order, h[order])
    if all((x[first][number] == x).all() for x in columns):
        return first, number
    order = np.lexsort(columns)
    return _runs(order, *[x[order] for x in columns])


def _runs(order: np.ndarray, *sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in sorted_:
        new[1:] |= x[1:] != x[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _met(rows: np.ndarray) -> np.ndarray:
    """Distinct (a, b, p) with the sum of n."""
    first, number = _distinct(*rows[:3])
    out = rows[:, first]
    out[3] = np.bincount(number, rows[3], len(first))
    return out


def _cuts(keys: np.ndarray) -> zip:
    """(key, start, end) of the runs of sorted keys."""
    cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return zip(keys[cut].tolist(), cut.tolist(), np.append(cut[1:], len(keys)).tolist())


def _requests(docs: DataFrame, know) -> DataFrame:
    """(q, size, block): what parts must be told, for the owner q: (a, b, p, n), packed.

    With ``a = _COUNT``: the count of the word b.  Else: of the word b after
    the dealt word a.  ``n`` are the training occurrences in the part p.
    """

    def run(batches):
        k = know.value

        def out(asked):
            rows = _met(np.concatenate(asked, axis=1))
            q = k.owner(rows[0], rows[1])
            order = np.lexsort((rows[2], rows[1], rows[0], q))
            rows, q = rows[:, order], q[order]
            for owner, start, end in _cuts(q):
                block = _packed(rows[:, start:end].ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner]), pa.array([end - start]), pa.array([block], pa.binary())], ["q", "size", "block"]
                )

        held = []
        for x in _chunks(batches, k):
            p = k.part(x.before[0], x.before[1])
            rare = k.asked(x.word)
            dealt = (k.dealt(x.before[0]) > 1) if k.depth else np.zeros(len(p), bool)
            train = x.train[x.doc].astype(np.int64)
            a = np.concatenate([np.full(rare.sum(), _COUNT, np.int64), x.before[0][dealt]])
            b, q, n = (np.concatenate([y[rare], y[dealt]]) for y in (x.word, p, train))
            held.append(_met(np.stack([a, b, q, n])))
            if sum(y.shape[1] for y in held) >= _ASKED:
                yield from out(held)
                held = []
        if held:
            yield from out(held)

    return docs.mapInArrow(run, "q long, size long, block binary")


_ANSWERS = "p long, size long, block binary, a long, n double, k double, mass double, gain double, covered double"


def _answers(asked: DataFrame, counts: DataFrame, know) -> DataFrame:
    """(p, size, block, ...): what parts are told: (a, b, v, c), packed.

    c is the count of the word b and v, after a dealt word a, how often b
    follows it in the training texts.  Rows without p hold what the owner's
    pairs add to the state a.
    """
    names = [x.split()[0] for x in _ANSWERS.split(", ")]

    def owned(batches):
        k = know.value
        for x in batches:
            codes = x.column("code").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(k.owner(codes, codes)), *x.columns], ["q", "code", "c"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        k = know.value
        blocks = [_unpacked(y.as_py(), 4 * n).reshape(4, n) for n, y in zip(left.column("size").to_pylist(), left.column("block"))]
        a, b, p, n = _met(np.concatenate([np.zeros((4, 0), np.int64), *blocks], axis=1))
        first, pair = _distinct(a, b)
        every = np.bincount(pair, n, len(first)).astype(np.int64)
        word = b[first]
        # A word that is not found occurs once: its count is that of its only pair.
        c = every.copy()
        common = word < _RARE
        c[common] = k.count[word[common]]
        codes, of_codes = (right.column(x).to_numpy() for x in ("code", "c"))
        if len(codes):
            order = np.argsort(codes)
            at = order[np.minimum(np.searchsorted(codes, word, sorter=order), len(codes) - 1)]
            c = np.where(codes[at] == word, of_codes[at], c)
        # What the pairs add to the dealt states.
        own = (a[first] != _COUNT) & (every > 0)
        state, at = np.unique(a[first][own], return_inverse=True)
        root, m = k.root(c[own]), every[own] - DISCOUNT
        values = (every[own], np.ones(len(m)), m, m * (np.log10(m) - root), 10.0**root)
        sums = [np.bincount(at, y, len(state)).astype(float) for y in values]
        order = np.lexsort((b, a, p))
        rows = np.stack([a, b, every[pair], c[pair]])[:, order]
        told = [(q, z - i, _packed(rows[:, i:z].ravel())) for q, i, z in _cuts(p[order])]
        columns = [pa.array([t[j] for t in told], y) for j, y in enumerate((pa.int64(), pa.int64(), pa.binary()))]
        columns = [pa.concat_arrays([x, pa.nulls(len(state), x.type)]) for x in columns]
        columns += [pa.concat_arrays([pa.nulls(len(told), x.type), x]) for x in map(pa.array, (state, *sums))]
        return pa.table(columns, names)

    others = counts.where((F.col("m") > 1) & (F.col("m") < 2.0**know.value.least)).select("code", "c")
    others = others.mapInArrow(owned, "q long, code long, c long")
    return asked.groupBy("q").cogroup(others.groupBy("q")).applyInArrow(run, _ANSWERS)


@dataclass(frozen=True)
class States:
    """The dealt words' own states: words in order, training occurrences, log10 of the rest weight."""

    word: np.ndarray
    size: np.ndarray
    weight: np.ndarray
    kept: np.ndarray

    def values(self, a: np.ndarray, n: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P(b | a) of pairs that occur n times, and whether their state is retained."""
        if not len(self.word):
            return root, np.zeros(len(root), bool)
        at = np.minimum(np.searchsorted(self.word, a), len(self.word) - 1)
        is_kept = self.kept[at] & (self.word[at] == a)
        own = np.where(
            n > 0, np.log10(np.maximum(n - DISCOUNT, _LEAST)) - np.log10(self.size[at]), self.weight[at] + root
        )
        return np.where(is_kept, own, root), is_kept


def _states(answers: DataFrame, min_divergence: float) -> States:
    sums = [F.sum(x).alias(x) for x in ("n", "k", "mass", "gain", "covered")]
    # At most two rows a part.
    got = answers.where(F.col("p").isNull()).groupBy("a").agg(*sums).orderBy("a").toArrow()
    word, size, k, mass, gain, covered = (got.column(x).to_numpy() for x in ("a", "n", "k", "mass", "gain", "covered"))
    rest = np.maximum(DISCOUNT * k / size, _LEAST)
    weight = np.log10(rest / np.maximum(1 - covered, _LEAST))
    divergence = ((gain - np.log10(size) * mass) / size + rest * weight) * np.log(10.0)
    return States(word, size, weight, divergence >= min_divergence)


_BLOCKS = (
    "p long, size long, first long, block binary, ids array<long>, lens array<long>, known array<long>, logs array<double>"
)


def _blocks(docs: DataFrame, know) -> DataFrame:
    """(p, size, first, block, ...): tokens by part, with the numbers of their texts from ``first`` on.

    One block of a chunk carries what its texts' common words tell: ids,
    lengths, known tokens and sums of log10(c + 1).
    """

    def run(batches):
        k = know.value
        row = TaskContext.get().partitionId() << 33
        for turn, x in enumerate(_chunks(batches, k)):
            doc = x.doc
            c = np.full(len(doc), -1, np.int64)
            common = x.word < _RARE
            c[common] = k.count[x.word[common]]
            known = np.bincount(doc, c > 0, len(x.ids)).astype(np.int64)
            logs = np.bincount(doc, np.log10(np.maximum(c, 0) + 1.0), len(x.ids))
            p = k.part(x.before[0], x.before[1])
            order = np.argsort((p << 40) | (x.before[0] & ((1 << 40) - 1)))
            rows = np.stack([*x.before[: k.depth], x.word, 2 * doc + x.train[doc]])[:, order]
            cut = np.flatnonzero(np.append(True, p[order][1:] != p[order][:-1]))
            ends = np.append(cut[1:], len(order))
            mine = turn % len(cut)
            for i, (a, z) in enumerate(zip(cut.tolist(), ends.tolist())):
                told = [x.ids, x.lens, known, logs] if i == mine else [None] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p[order[a]]], pa.int64()), pa.array([z - a], pa.int64()), pa.array([row], pa.int64()),
                        pa.array([_packed(np.ascontiguousarray(rows[:, a:z]).ravel())], pa.binary()),
                        *(pa.array([t], pa.list_(pa.float64() if j == 3 else pa.int64())) for j, t in enumerate(told)),
                    ],
                    [f.split()[0] for f in _BLOCKS.split(", ")],
                )
            row += len(x.ids)  # so chunks of the task differ in their first number

    return docs.mapInArrow(run, _BLOCKS)


def levels(
    before: list[np.ndarray], word: np.ndarray, train: np.ndarray, root: np.ndarray, min_divergence: float, told=None
) -> np.ndarray:
    """log10 P of every token in the longest retained state of the part.

    ``train`` says how often a token counts.  ``told`` (rows, their log10 P,
    whether their state is retained) are rows with a first state that lies in
    several parts; all rows of such a state have one.
    """
    lp, kept, context = root, np.ones(len(word), bool), np.zeros(len(word), np.int64)
    for level, x in enumerate(before):
        _, context = _distinct(context, x)
        first, sequence = _distinct(context, word)
        of = context[first]
        n = np.bincount(sequence, train, len(first))
        states = int(context.max()) + 1 if len(context) else 0
        suffix = lp[first]
        own = (n > 0) & kept[first] & (x[first] != _PAD)
        at, m, s = of[own], n[own] - DISCOUNT, suffix[own]

        def per_state(values):
            return np.bincount(at, values, states)

        size, k = per_state(n[own]), np.bincount(at, minlength=states)
        some = np.maximum(size, 1)
        rest = np.maximum(DISCOUNT * k / some, _LEAST)
        weight = np.log10(rest / np.maximum(1 - per_state(10.0**s), _LEAST))
        gain = per_state(m * (np.log10(m) - s))
        divergence = ((gain - np.log10(some) * per_state(m)) / some + rest * weight) * np.log(10.0)
        retained = (size > 0) & (divergence >= min_divergence)
        value = np.where(n > 0, np.log10(np.maximum(n - DISCOUNT, _LEAST)) - np.log10(some[of]), weight[of] + suffix)
        value = np.where(retained[of], value, suffix)
        if level == 0 and told is not None:
            rows, log, is_kept = told
            value[sequence[rows]] = log
            retained[context[rows]] = is_kept
        lp, kept = value[sequence], retained[context]
    return lp


# What a part tells of the texts of one chunk: their places in it, known rare tokens, sums of log10.
_SUMS = (
    "first long, size long, texts binary, known binary, log binary, full binary, "
    "ids array<long>, lens array<long>, hot_known array<long>, logs array<double>"
)
_RESULT = "doc_id long, n_tokens long, known long, log double, full double"


def _scored(blocks: DataFrame, answers: DataFrame, know, states, min_divergence: float) -> DataFrame:
    """Each part's sums by text, packed by chunk."""
    names = [x.split()[0] for x in _SUMS.split(", ")]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        k = know.value
        width = k.depth + 2
        sizes, firsts = left.column("size").to_pylist(), left.column("first").to_numpy()
        info = [left.column(x) for x in ("ids", "lens", "known", "logs")]
        blocks = zip(sizes, left.column("block"))
        x = np.concatenate([_unpacked(b.as_py(), n * width).reshape(width, n) for n, b in blocks], axis=1)
        word, train = x[-2], (x[-1] & 1).astype(np.float64)
        text = x[-1] >> 1
        told = [_unpacked(y.as_py(), 4 * n).reshape(4, n) for n, y in zip(right.column("size").to_pylist(), right.column("block"))]
        a, b, v, of_b = np.concatenate([np.zeros((4, 0), np.int64), *told], axis=1)
        counts = a == _COUNT
        order = np.argsort(b[counts])
        codes, told_c = b[counts][order], of_b[counts][order]
        # Rows of the dealt states, which count nothing and belong to no text.
        pairs = ~counts
        extra = int(pairs.sum())
        word = np.append(word, b[pairs])
        c = np.zeros(len(word))
        common = word < _RARE
        c[common] = k.count[word[common]]
        # A word that nobody asked for occurs once: here, in a training text or not.
        once = ~common & ~k.asked(word)
        c[: len(train)][once[: len(train)]] = train[once[: len(train)]]
        rest = ~common & ~once
        if len(codes) and rest.any():
            at = np.minimum(np.searchsorted(codes, word[rest]), len(codes) - 1)
            c[rest] = np.where(codes[at] == word[rest], told_c[at], 0)
        before = [np.append(x[j], a[pairs] if j == 0 else np.full(extra, _PAD, np.int64)) for j in range(k.depth)]
        x = None
        values = states.value.values(a[pairs], v[pairs], k.root(of_b[pairs])) if extra else ()
        told = (np.arange(len(word) - extra, len(word)), *values) if extra else None
        lp = levels(before, word, np.append(train, np.zeros(extra)), k.root(c), min_divergence, told)
        packed = []
        start = 0
        for n in sizes:
            own = slice(start, start + n)
            start += n
            texts, at = np.unique(text[own], return_inverse=True)
            rare = ~common[own]
            known = np.bincount(at, (c[own] > 0) & rare, len(texts)).astype(np.int64)
            log = np.bincount(at, np.where(rare, np.log10(c[own] + 1), 0.0), len(texts))
            full = np.bincount(at, lp[own], len(texts))
            packed.append((len(texts), *(_packed(y.view(np.int64)) for y in (texts, known, log, full))))
        columns = [pa.array(y, t) for y, t in zip(zip(*packed), (pa.int64(), *[pa.binary()] * 4))]
        return pa.table([pa.array(firsts, pa.int64()), *columns, *info], names)

    told = answers.where(F.col("p").isNotNull()).select("p", "size", "block")
    return blocks.groupBy("p").cogroup(told.groupBy("p")).applyInArrow(run, _SUMS)


def _summed(sums: DataFrame) -> DataFrame:
    """One row per text, from what all parts tell of its chunk."""

    def run(parts: pa.Table) -> pa.Table:
        told = next(r for r in parts.select(["ids", "lens", "hot_known", "logs"]).to_pylist() if r["ids"] is not None)
        n = len(told["ids"])
        known, log, full = np.array(told["hot_known"], np.int64), np.array(told["logs"]), np.zeros(n)
        for size, *packed in zip(*(parts.column(x) for x in ("size", "texts", "known", "log", "full"))):
            texts, k, g, f = (_unpacked(y.as_py(), size.as_py()) for y in packed)
            known[texts] += k
            log[texts] += g.view(np.float64)
            full[texts] += f.view(np.float64)
        arrays = [pa.array(told["ids"], pa.int64()), pa.array(told["lens"], pa.int64())]
        arrays += [pa.array(y) for y in (known, log, full)]
        return pa.table(arrays, [x.split()[0] for x in _RESULT.split(", ")])

    return sums.groupBy("first").applyInArrow(run, _RESULT)


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = 2,
    min_divergence: float = MIN_DIVERGENCE,
    hot_words: int = HOT_WORDS,
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    if not isinstance(depth, int) or depth < 0:
        raise ValueError(f"depth must be a whole number from 0, not {depth!r}")
    docs = id_text(docs, id_col, text_col)
    counts, seed = distinct_codes(docs)
    known = shared(counts, seed, depth, hot_words, part_tokens)
    total, types = (known.total, known.types) if known else (0, 0)
    if known is None:
        rows = docs.sparkSession.createDataFrame([], _RESULT)
    else:
        know = docs.sparkSession.sparkContext.broadcast(known)
        answers = staged(_answers(_requests(docs, know), counts, know), "lm-answers")
        states = docs.sparkSession.sparkContext.broadcast(_states(answers, min_divergence))
        rows = _summed(_scored(_blocks(docs, know), answers, know, states, min_divergence))
    root = F.col("n_tokens") * F.log10(F.lit(float(total + types + 1)))
    return rows.select(
        "doc_id",
        _is_held_out("doc_id").alias("held_out"),
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log") - root).alias("base_score"),
        F.col("full").alias("score"),
    )

"""Toxicity: a logistic classifier regularised by counterfactual pairs.

Features are the words of a text (letters and digits, case folded) and the
proper prefixes of a few lengths (stems that endings follow), each present
or not.  A run of more than ``LONG`` letters, as scripts without spaces have
them, also counts by each three characters in a row.  A bounded sample of the
labelled training texts (``max_sample``, smallest id hashes first) selects
the features whose presence depends on the label (log-likelihood
ratio), and always
the identity terms it contains.  The weights minimise

    mean log loss + l2 |w|^2 / 2 + fairness * mean (z(x) - z(x'))^2

where x' is a labelled text x whose sentences have every identity term
swapped for another one of its group, and z is the score before the logistic
function.  The last term punishes a score that changes with the group named,
so neutral mentions don't count as toxic.

The groups are the fixed ones and those found in the sampled texts: words
that stand in for each other (their most frequent pair of neighbours is the
same), that are mostly used in texts which are not toxic, and whose label
rates differ all the same (``stand_ins``).

Only the text enters a score.  Scoring passes over every whole text once,
looking up distinct words, and needs no shuffle.

Defined cases: null and empty texts have no features and get the base score;
a null id counts as the empty text in the hold-out rule (not held out); null
labels are skipped, and an id with several labels is toxic if one says so;
repeated rows get equal scores; without labels of both kinds every score is
the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from enrolmart.llm.common import col, map_rows, staged

THRESHOLD = 0.7
MAX_SAMPLE = 20_000
MAX_FEATURES = 4096
MIN_G2 = 20.0
PREFIXES = (3, 4, 5, 6, 7, 8)
L2 = 1e-4
FAIRNESS = 1.0
# Groups of identity terms whose mention alone says nothing.
IDENTITY_GROUPS = (
    ("men", "women"),
    ("man", "woman"),
    ("male", "female"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("american", "mexican", "african", "european", "chinese"),
    ("immigrant", "native"),
    ("old", "young"),
    ("männer", "frauen"),
    ("christen", "muslime", "juden"),
    ("hommes", "femmes"),
    ("chrétiens", "musulmans", "juifs"),
    ("hombres", "mujeres"),
    ("cristianos", "musulmanes", "judíos"),
)
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[.!?\n]+")
# Letters in a row beyond which a word's name is a digest and its parts count as well.
LONG = 64
_TEXTS = 512
# Groups found in the texts: uses that a word and its frame need, words a group, groups.
MIN_USES = 30
MIN_FRAMED = 5
GROUP_WORDS = 8
MAX_GROUPS = 64
# The chi-square bound (one degree of freedom, 5 %) from which label rates differ.
RATES_DIFFER = 3.84


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str, prefixes=PREFIXES) -> list[str]:
    starts = ["^" + word[:n] for n in prefixes if len(word) > n]
    if len(word) <= LONG:
        return ["=" + word, *starts]
    whole = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    return ["#" + whole, *starts, *{"~" + word[i : i + 3] for i in range(len(word) - 2)}]


def _features_of(ws, prefixes) -> set[str]:
    return set(chain.from_iterable(features(w, prefixes) for w in set(ws)))


def _swaps(groups) -> list[dict[str, str]]:
    """Maps from each identity term to the next and to the one after it in its group."""
    return [
        {t: g[(i + step) % len(g)] for g in groups for i, t in enumerate(g)} for step in (1, 2)
    ]


def examples(text: str, groups, prefixes=PREFIXES) -> tuple[set[str], list[set[str]]]:
    """Features of a text, and of its counterfactuals (sentences with identity terms swapped)."""
    sentences = [words(s) for s in _SENTENCE.split(text)]
    own = _features_of(chain.from_iterable(sentences), prefixes)
    others = []
    for swap in _swaps(groups):
        if any(w in swap for s in sentences for w in s):
            swapped = [[swap.get(w, w) for w in s] for s in sentences]
            other = _features_of(chain.from_iterable(swapped), prefixes)
            if other != own:
                others.append(other)
    return own, others


def in_training(doc_id, mod: int = 3, rest: int = 1):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod != rest


def sample(docs: DataFrame, labels: DataFrame, max_sample: int, id_col: str, text_col: str):
    """(y, text) of at most max_sample training texts with a label, one per id.

    Of rows that share an id, the one with the smallest text hash counts.
    """
    held = (
        labels.select(col("doc_id").cast("long").alias("i"), col("toxic").cast("int").alias("y"))
        .where(F.col("y").isNotNull() & F.col("i").isNotNull() & in_training(F.col("i")))
        .groupBy("i")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("i"), "i")
        .limit(max_sample)
    )
    texts = docs.select(
        col(id_col).cast("long").alias("doc_id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # At most max_sample pairs of numbers are broadcast.
    found = texts.join(F.broadcast(held), F.col("doc_id") == F.col("i"))
    # Each task hands on one row per id, so an id with many rows weighs like any other.
    first = F.min_by("text", F.md5(F.col("text").cast("binary")))
    return found.groupBy("i").agg(F.max("y").alias("y"), first.alias("text")).select("y", "text")


def stand_ins(
    found: DataFrame,
    known=IDENTITY_GROUPS,
    min_uses: int = MIN_USES,
    min_framed: int = MIN_FRAMED,
    max_groups: int = MAX_GROUPS,
) -> tuple[tuple[str, ...], ...]:
    """Groups of words of the (y, text) sample that stand in for each other.

    A word's frame is its most frequent pair of neighbours in a sentence, which at least
    min_framed texts hold.  Words of one frame are a group.  Words of fewer than min_uses
    uses, or with at least half of them in toxic texts (what insults are), are no members;
    groups in which no two label rates differ are left out.  Ties go to the smaller word.
    """

    def run(batches):
        for b in batches:
            for y, text in zip(*(c.to_pylist() for c in b.columns)):
                seen = set()
                for s in _SENTENCE.split(text):
                    ws = ["", *words(s), ""]
                    seen.update((a, w, z) for a, w, z in zip(ws, ws[1:], ws[2:]) if len(w) <= LONG)
                cols = list(zip(*sorted(seen))) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.string()) for c in cols), pa.array([y] * len(seen), pa.int32())],
                    ["before", "w", "after", "y"],
                )

    framed = (
        found.mapInArrow(run, "before string, w string, after string, y int")
        .groupBy("before", "w", "after")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("t"))
    )
    best = F.struct("n", "before", "after")
    named = sorted({w for g in known for w in g})
    members = (
        framed.groupBy("w")
        .agg(F.sum("n").alias("uses"), F.sum("t").alias("toxic"), F.max(best).alias("frame"))
        .where((F.col("uses") >= min_uses) & (F.col("frame.n") >= min_framed))
        .where(2 * F.col("toxic") < F.col("uses"))
        .where(~F.col("w").isin(named))
    )
    # The most used words of a frame: a bounded group, whatever the frame's number of words.
    order = Window.partitionBy("frame.before", "frame.after").orderBy(F.desc("uses"), "w")
    rows = (
        members.withColumn("k", F.row_number().over(order))
        .where(F.col("k") <= GROUP_WORDS)
        .groupBy("frame.before", "frame.after")
        .agg(
            F.sort_array(F.collect_list(F.struct("w", "uses", "toxic"))).alias("g"),
            F.sum("uses").alias("all"),
        )
        .where(F.size("g") > 1)
        .collect()  # fewer rows than the bounded sample has frequent words
    )

    def differ(g) -> bool:
        low = min(g, key=lambda r: r["toxic"] / r["uses"])
        high = max(g, key=lambda r: r["toxic"] / r["uses"])
        n, t = low["uses"] + high["uses"], low["toxic"] + high["toxic"]
        gap = high["toxic"] / high["uses"] - low["toxic"] / low["uses"]
        spread = t / n * (1 - t / n) * (1 / low["uses"] + 1 / high["uses"])
        return spread > 0 and gap * gap / spread >= RATES_DIFFER

    groups = sorted((-r["all"], tuple(m["w"] for m in r["g"])) for r in rows if differ(r["g"]))
    return tuple(g for _, g in groups[:max_groups])


def _select(found: DataFrame, groups, max_features: int, min_g2: float, prefixes) -> list[str]:
    """Features that depend on the label; the identity terms among all features come first."""

    def run(batches):
        for b in batches:
            for y, text in zip(*(c.to_pylist() for c in b.columns)):
                own, others = examples(text, groups, prefixes)
                every = sorted(own.union(*others))
                seen = [f in own for f in every]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every, pa.string()), pa.array([y] * len(every), pa.int32()),
                     pa.array(seen, pa.bool_())],
                    ["f", "y", "own"],
                )

    total, toxic = found.agg(F.count(F.lit(1)), F.sum("y")).first()
    toxic = toxic or 0
    seen = F.col("own").cast("long")
    n, t = F.col("n"), F.col("t")
    share = toxic / max(total, 1)

    def part(k, p):
        """k log(k / (n p)), zero for k = 0."""
        return F.when(k > 0, k * F.log(k / (n * F.lit(max(p, 1e-9))))).otherwise(0.0)

    g2 = 2 * (part(t, share) + part(n - t, 1 - share))
    terms = sorted({"=" + w for g in groups for w in g})
    named = F.col("f").isin(terms)
    rows = (
        found.mapInArrow(run, "f string, y int, own boolean")
        .groupBy("f")
        .agg(F.sum(seen).alias("n"), F.sum(seen * F.col("y")).alias("t"))
        .select("f", g2.alias("g2"), named.alias("named"))
        .where((F.col("g2") >= min_g2) | F.col("named"))
        .orderBy(F.desc("named"), F.desc("g2"), "f")
        .limit(max_features + len(terms))
        .collect()
    )
    return [r["f"] for r in rows]


class Problem:
    """The sum to minimise over the weights and, last, the bias.

    ``own`` holds each text's features, ``pairs`` the features that a text has and its
    counterfactual has not, and the other way round.
    """

    def __init__(self, y, own, pairs, size: int, l2: float, fairness: float):
        self.y, self.size, self.l2, self.fairness = y, size, l2, fairness
        self.doc = np.repeat(np.arange(len(y)), [len(s) for s in own])
        self.feature = np.fromiter(chain.from_iterable(own), np.int64, len(self.doc))
        self.pairs = len(pairs)
        lens = [len(side) for p in pairs for side in p]
        self.pair = np.repeat(np.repeat(np.arange(len(pairs)), 2), lens).astype(np.int64)
        self.sign = np.repeat(np.tile([1.0, -1.0], len(pairs)), lens)
        self.changed = np.fromiter(
            chain.from_iterable(side for p in pairs for side in p), np.int64, sum(lens)
        )

    def __call__(self, at: np.ndarray) -> tuple[float, np.ndarray]:
        """The value and its gradient."""
        w, bias, n, k = at[:-1], at[-1], len(self.y), self.size
        z = np.bincount(self.doc, w[self.feature], n) + bias
        p = 1 / (1 + np.exp(-z))
        value = (np.logaddexp(0, z) - self.y * z).mean() + self.l2 / 2 * (w @ w)
        g = np.append(
            np.bincount(self.feature, (p - self.y)[self.doc], k) / n + self.l2 * w,
            (p - self.y).mean(),
        )
        if self.pairs:
            gap = np.bincount(self.pair, self.sign * w[self.changed], self.pairs)
            value += self.fairness * (gap @ gap) / self.pairs
            moved = np.bincount(self.changed, self.sign * gap[self.pair], k)
            g[:k] += self.fairness * 2 / self.pairs * moved
        return value, g


def problem(
    found: DataFrame,
    groups=None,
    fairness: float = FAIRNESS,
    l2: float = L2,
    max_features: int = MAX_FEATURES,
    min_g2: float = MIN_G2,
    prefixes: tuple[int, ...] = PREFIXES,
) -> tuple[list[str], Problem]:
    """The selected features and the problem in them, from the (y, text) of ``sample``.

    ``groups`` are the groups to swap within; if None, the fixed ones and ``stand_ins``.
    """
    found = staged(found, "toxicity-sample")
    if groups is None:
        groups = IDENTITY_GROUPS + stand_ins(found)
    names = _select(found, groups, max_features, min_g2, prefixes)
    place = {f: i for i, f in enumerate(names)}

    def run(batches):
        for b in batches:
            for y, text in zip(*(c.to_pylist() for c in b.columns)):
                own, others = examples(text, groups, prefixes)
                own = {place[f] for f in own if f in place}
                others = [{place[f] for f in o if f in place} for o in others]
                pairs = [[sorted(own - o), sorted(o - own)] for o in others if o != own]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([y], pa.int32()),
                        pa.array([sorted(own)], pa.list_(pa.int32())),
                        pa.array([pairs], pa.list_(pa.list_(pa.list_(pa.int32())))),
                    ],
                    ["y", "own", "pairs"],
                )

    # One row per sampled text, with its few selected features and what swaps change of them.
    rows = found.mapInArrow(run, "y int, own array<int>, pairs array<array<array<int>>>").toArrow()
    y = rows.column("y").to_numpy().astype(float)
    pairs = list(chain.from_iterable(rows.column("pairs").to_pylist()))
    return names, Problem(y, rows.column("own").to_pylist(), pairs, len(names), l2, fairness)


def fit(found: DataFrame, steps: int = 600, **options) -> tuple[dict[str, float], float]:
    """Weights by feature and the bias, from the (y, text) of ``sample``."""
    names, target = problem(found, **options)
    y = target.y
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return {}, np.log((share + 1e-9) / (1 - share + 1e-9))
    at = np.append(np.zeros(len(names)), np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(len(at)), np.zeros(len(at))
    for step in range(1, steps + 1):  # Adam on the whole sample
        g = target(at)[1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        at = at - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {f: float(x) for f, x in zip(names, at)}, float(at[-1])


class Scorer:
    """Scores of texts, through their distinct space-separated parts."""

    def __init__(self, weights: dict[str, float], bias: float, prefixes=PREFIXES):
        names = list(weights)
        self.place = {f: i for i, f in enumerate(names)}
        self.weights, self.bias = np.array([weights[f] for f in names]), bias
        self.prefixes = prefixes

    def __call__(self, texts: pa.Array) -> np.ndarray:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        lists = [
            [self.place[f] for w in words(part) for f in features(w, self.prefixes) if f in self.place]
            for part in coded.dictionary.to_pylist()
        ]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum()))
        starts = np.cumsum(size) - size
        part = coded.indices.to_numpy()
        doc = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
        has = size[part] > 0
        part, doc = part[has], doc[has]
        n = size[part]
        at = np.arange(n.sum()) + np.repeat(starts[part] - np.cumsum(n) + n, n)
        k = max(len(self.weights), 1)
        present = np.unique(np.repeat(doc, n) * k + flat[at])
        z = np.bincount(present // k, self.weights[present % k], len(texts)) if len(present) else (
            np.zeros(len(texts))
        )
        return 1 / (1 + np.exp(-(z + self.bias)))


def model(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", **options):
    found = sample(docs, labels, options.pop("max_sample", MAX_SAMPLE), id_col, text_col)
    return fit(found, **options)


def _scores(shared, texts):
    weights, bias = shared.value
    scorer = Scorer(weights, bias)
    return np.concatenate(
        [scorer(texts.slice(i, _TEXTS)) for i in range(0, len(texts), _TEXTS)] or [np.zeros(0)]
    )


def score(docs: DataFrame, fitted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # at most MAX_FEATURES and the terms

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_scores(shared, b.column("text")))],
                ["doc_id", "score"],
            )

    slim = docs.select(
        col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text")
    )
    return slim.mapInArrow(run, "doc_id long, score double")


def reject(docs: DataFrame, fitted, threshold: float = THRESHOLD, text_col="text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(shared, b.column(place)) < threshold))

    return map_rows(docs, run)


def op5(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, model(docs, labels)).select(
        "doc_id",
        (~in_training(F.col("doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

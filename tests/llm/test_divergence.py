"""The divergence audit against its definition in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from enrolmart.llm import divergence

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def by_definition(rows, min_docs=10, top=10):
    """rows: (lang, source, text)."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(FOLD))
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []

    def ranked(lang, source, part, items, first):
        items.sort(key=lambda x: (-x[1], x[0].encode()))
        out.extend((lang, source, part, item, value, k) for k, (item, value) in enumerate(items[:first], 1))

    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (n[s] + 2 * v) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (whole[t] + 2) // (sum(n.values()) + 2 * v) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            others = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            ranked(lang, s, "pair", others, len(others))
            mine = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            ranked(lang, s, "term", mine, top)
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(df.dtypes)["value"] == "bigint" and dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


def rows_of(seed, n, sources=12):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "uvwxyzÄß日"] + ["Upper", "lower", "UPPER"]
    for _ in range(n):
        lang = rng.choice(["en", "de", None, ""])
        source = rng.choice([None, *(f"s{k}" for k in range(sources))])
        own = words[: rng.randint(5, len(words))]
        text = "".join(rng.choice(own) + rng.choice([" ", ", ", "1", "\n", "_", "\x00"]) for _ in range(rng.randint(0, 40)))
        yield lang, source, text or None


SCHEMA = "lang string, source string, text string"


@pytest.mark.parametrize("block", [400_000, 7])
def test_by_definition(frame, block):
    rows = list(rows_of(1, 500))
    rows += rows[:30] + [("fr", "only", "rare words here"), ("fr", "none", None), ("it", "alone", "x")]
    got = result(divergence.audit(frame(rows, SCHEMA), block=block))
    assert got == by_definition(rows)


def test_small_parts_change_nothing(frame, spark):
    """Corrections in parts of a few pairs."""
    rows = list(rows_of(2, 300, 30))
    whole = result(divergence.audit(frame(rows, SCHEMA), min_docs=3))
    assert whole == by_definition(rows, 3)
    plain = divergence._corrections
    try:
        divergence._corrections = lambda index, groups: plain(index, groups, pairs_held=64, at_once=50)
        assert result(divergence.audit(frame(rows, SCHEMA), min_docs=3)) == whole
    finally:
        divergence._corrections = plain


def test_hot_source_and_long_text(frame):
    rows = list(rows_of(3, 200)) + [("en", "hot", "au av aw " * 3)] * 150 + [("en", "long", "au bv " * 40_000)]
    assert result(divergence.audit(frame(rows, SCHEMA))) == by_definition(rows)


def test_terms_that_span_batches(spark, frame):
    rows = list(rows_of(4, 300, 25))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        assert result(divergence.audit(frame(rows, SCHEMA))) == by_definition(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_shares_beyond_64_bits():
    """1e9 * count does not fit a long."""
    count, size = np.array([5, 10**15]), np.array([40, 3 * 10**15])
    got = divergence.shares(count, size)
    assert got.tolist() == [10**9 * 7 // 40 + 1, 10**9 * (10**15 + 2) // (3 * 10**15) + 1]


def test_shares_in_spark_are_exact(spark):
    from pyspark.sql import functions as F

    rows = [(0, 7), (10**15, 3 * 10**15), (9 * 10**17, 10**18)]
    df = spark.createDataFrame(rows, "c long, s long")
    got = [r[0] for r in df.select(divergence._share(F.col("c"), F.col("s"))).collect()]
    assert got == [10**9 * (c + 2) // s + 1 for c, s in rows]


def test_empty(frame):
    assert result(divergence.audit(frame([], SCHEMA))) == []
    rows = [(None, None, None), ("en", "a", ""), ("en", "b", "1 2 3")]
    assert result(divergence.audit(frame(rows, SCHEMA))) == by_definition(rows)

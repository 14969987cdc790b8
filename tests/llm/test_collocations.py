"""Phrase collocations against counting every phrase."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from enrolmart.llm import collocations

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_definition(rows, min_count, max_words=4, top=2000):
    """rows: (lang, text).  The result as sorted tuples."""
    f = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall("[^\x20\x09]+", piece)
            for n in range(1, max_words + 1):
                f.update(("und" if lang is None else lang, *w[i : i + n]) for i in range(len(w) - n + 1))
    total = Counter()
    for (lang, *w), c in f.items():
        if len(w) == 1:
            total[lang] += c
    found = {g: a for g, a in f.items() if len(g) > 2 and a >= min_count}
    out = []
    for (lang, *w), a in found.items():
        if any(
            100 * b >= 80 * a and any(list(x[i : i + len(w)]) == w for i in range(len(x) - len(w) + 1))
            for (other, *x), b in found.items()
            if other == lang and len(x) > len(w)
        ):
            continue
        cuts = [
            (2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])])
            for k in range(1, len(w))
        ]
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    out.sort()
    rank, got = Counter(), []
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return got


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def prose(seed, texts, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["Ünï", "日本", "\x1codd", "\x00", "A b"]
    fixed = ["of the old town", "in the old town hall", "New York", "new york city"]
    for k in range(texts):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words[: rng.randint(1, len(words))]))
            parts.append(rng.choice([" ", "  ", "\t", ", ", ". ", "\n", " ", " "]))
        yield (rng.choice([None, "und", "en", ""]), "".join(parts) or None)


@pytest.mark.parametrize("shards", [1, 9, 16])
def test_equals_counting_all(frame, shards):
    rows = [(4000 * k, *x) for k, x in enumerate(prose(3, 400))]
    rows += rows[:50]  # repeated rows count again
    docs = frame(rows, "doc_id long, lang string, text string")
    want = by_definition([r[1:] for r in rows], 12)
    assert len(want) > 20
    got = collocations.collocations(docs, min_count=12, shards=shards, chunk=500)
    assert result(got) == want


def test_tiny_filters_change_nothing(frame):
    rows = [(4000 * k, *x) for k, x in enumerate(prose(4, 300))]
    docs = frame(rows, "doc_id long, lang string, text string")
    got = collocations.collocations(docs, min_count=10, max_bits=64)
    assert result(got) == by_definition([r[1:] for r in rows], 10)


def test_longer_and_shorter_phrases(frame):
    rows = [(4000 * k, *x) for k, x in enumerate(prose(5, 200))]
    docs = frame(rows, "doc_id long, lang string, text string")
    for words in (2, 3):
        got = collocations.collocations(docs, min_count=8, max_words=words)
        assert result(got) == by_definition([r[1:] for r in rows], 8, words)


def test_top_and_ties(frame):
    rows = [(k, "en", f"a{i} b{i}. c{i} d{i} e{i}") for k in range(5) for i in range(120)]
    docs = frame(rows, "doc_id long, lang string, text string")
    got = collocations.collocations(docs, min_count=5, top=17)
    assert result(got) == by_definition([r[1:] for r in rows], 5, top=17)


def test_all_in_one_shard_one_id_one_text(frame):
    """A hot id, a hot phrase and one very long text."""
    rows = [(7, "en", "very hot phrase here. " * 50)] * 20 + [(None, "en", "cold " * 60_000 + "hot phrase")]
    docs = frame(rows, "doc_id long, lang string, text string")
    got = result(collocations.collocations(docs, chunk=1000))
    assert got == by_definition([r[1:] for r in rows], 30)


def test_counts_beyond_64_bits_in_products(spark):
    """2000000 * a does not fit a long."""
    a = 5 * 10**15
    phrases = spark.createDataFrame([("en", "x y", 2, a)], "lang string, phrase string, size int, a long")
    words = spark.createDataFrame([("en", "x", a + 1), ("en", "y", 3 * a + 7)], "lang string, word string, c long")
    got = collocations.scored(phrases, words).collect()
    assert [tuple(r) for r in got] == [("en", "x y", a, a + 1, 3 * a + 7, 2_000_000 * a // (4 * a + 8))]


def test_empty(frame):
    docs = frame([], "doc_id long, lang string, text string")
    assert result(collocations.collocations(docs)) == []
    blank = frame([(1, "en", None), (2, None, " \t"), (3, "en", ".;")], "doc_id long, lang string, text string")
    assert result(collocations.collocations(blank)) == []


def test_shards_are_checked(frame):
    docs = frame([(1, "en", "a b")], "doc_id long, lang string, text string")
    with pytest.raises(ValueError):
        collocations.collocations(docs, shards=17)


def test_filter_holds_all_its_keys(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("key"))
    held = collocations.bloom(rows, collocations._keys, 5000)
    keys = rows.toArrow().column("key").to_numpy().view("uint64")
    assert held.holds(keys).all()
    others = spark.range(5000, 10000).select(F.xxhash64("id").alias("key")).toArrow().column("key").to_numpy()
    assert held.holds(others.view("uint64")).mean() < 0.05


def test_a_task_holds_a_small_chunk():
    import tracemalloc

    import pyarrow as pa

    def batches(n=300):
        for k in range(0, 3600, n):
            texts = [" ".join(f"w{i * j % 9973}" for j in range(400)) for i in range(k, k + n)]
            columns = [pa.array(["en"] * n), pa.array([1] * n, pa.int32()), pa.array(texts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "shard", "text"])

    tracemalloc.start()
    try:
        held = sum(int(x.is_word.sum()) for x in collocations._chunks(batches(), collocations._CHUNK))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held == 3600 * 400
    assert peak < 80e6  # 143 MB with chunks four times as long


def test_counts_are_handed_on_whenever_many_are_held(frame, monkeypatch):
    rows = [(4000 * k, *x) for k, x in enumerate(prose(6, 200))]
    docs = frame(rows, "doc_id long, lang string, text string")
    want = by_definition([r[1:] for r in rows], 8)
    assert len(want) > 10
    for held, part in ((1, 1 << 20), (300, 500), (1 << 20, 2000)):
        monkeypatch.setattr(collocations, "_FLUSH", held)
        monkeypatch.setattr(collocations, "_PART", part)
        assert result(collocations.collocations(docs, min_count=8, chunk=200)) == want


def test_words_of_a_chunk_are_handled_together():
    """No Python call for each word (the time of mining was mostly that)."""
    import sys

    import pyarrow as pa

    texts = [" ".join(f"w{i * j % 9973}" for j in range(400)) for i in range(300)]
    columns = [pa.array(["en"] * 300), pa.array([1] * 300, pa.int32()), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["lang", "shard", "text"])
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        held = sum(int(x.is_word.sum()) + 0 * len(x.one) for x in collocations._chunks([batch], collocations._CHUNK))
    finally:
        sys.setprofile(None)
    assert held == 300 * 400
    assert sum(calls.values()) < 3000  # over 20,000 with a call for each distinct word


def test_hashes_travel_in_blocks():
    """Rows follow chunks and parts, not phrases; a part has all of a key."""
    import numpy as np

    from enrolmart.llm.common import unpacked

    rng = np.random.default_rng(4)
    held = [np.unique(rng.integers(0, 2**64, 3000, np.uint64)[rng.integers(0, 3000, 9000)], return_counts=True)]
    held += [np.unique(np.append(held[0][0][::7], np.uint64(2**64 - 1)), return_counts=True)]
    want = Counter()
    for key, count in held:
        want.update(dict(zip(key.tolist(), count.tolist())))
    for parts in (1, 7, 100):
        got, parts_of = Counter(), {}
        batch = collocations._blocks(held, parts)
        assert batch.num_rows <= parts
        for q, size, block in zip(*(x.to_pylist() for x in batch.columns)):
            assert 0 <= q < parts
            keys, counts = unpacked(block, 2 * size).reshape(2, size)
            got.update(dict(zip(keys.view(np.uint64).tolist(), counts.tolist())))
            for k in keys.tolist():
                assert parts_of.setdefault(k, q) == q
        assert got == want

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from enrolmart.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_fp(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(rows, texts_by_key):
    """rows: collected op9 rows; compares with all pairs."""
    fps = [int(r.fingerprint, 16) for r in rows]
    comp = brute_components(fps)
    low = {}
    for r, c in zip(rows, comp):
        if r.doc_id is not None:
            low[c] = min(low.get(c, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [low.get(c) for c in comp]


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = S.op9(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    assert all(int(r.fingerprint, 16) == brute_fp(texts[r.doc_id]) for r in rows)
    check(rows, texts)


def test_edges(edge_docs):
    rows = S.op9(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {(r.doc_id, r.fingerprint): r for r in rows}
    assert by[(1, "0" * 16)].component_id == 1
    assert by[(2, "0" * 16)].component_id == 1 and by[(3, "0" * 16)].component_id == 1
    assert by[(6, f"{brute_fp(edge_docs.where('doc_id = 6').first().text):016x}")].component_id == 5
    check(rows, None)


def test_empty(no_docs):
    assert S.op9(no_docs).collect() == []
    assert S.keep_one(no_docs).collect() == []


def test_keep_one(edge_docs):
    kept = S.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    got = sorted(((r.doc_id, r.text and r.text[:20]) for r in kept.collect()), key=repr)
    # One of the blank ones, of id 4's copies, of the long ones; the rest are alone.
    assert [d for d, _ in got].count(1) == 1 and not {2, 3, 6} & {d for d, _ in got}
    assert [d for d, _ in got].count(4) == 2 and [d for d, _ in got].count(None) == 1
    assert {5, 7, 8} <= {d for d, _ in got}


@pytest.mark.parametrize("max_bits", [0, 2, 4])
@pytest.mark.parametrize("leaf", [1, 64])
def test_trie_join(monkeypatch, max_bits, leaf):
    monkeypatch.setattr(S, "_LEAF_PAIRS", leaf)
    monkeypatch.setattr(S, "_FRONTIER", 8)
    rng = np.random.default_rng(max_bits)
    centres = rng.integers(0, 1 << 63, 12, np.uint64)
    noisy = [int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for c in centres for _ in range(8)]
    groups = [sorted(set(noisy)), sorted({int(x) for x in rng.integers(0, 64, 30, np.uint64)}), [5]]
    fps = np.array([x for g in groups for x in g], np.uint64)
    bounds = np.cumsum([0, *map(len, groups)])
    got = S.trie_join(fps, bounds, max_bits)
    want = []
    for g, b in zip(groups, bounds):
        comp = brute_components(g, max_bits)
        first = {}
        for i, c in enumerate(comp):
            first.setdefault(c, b + i)
        want += [first[c] for c in comp]
    assert got.tolist() == want


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_masks_cover_every_pair(n):
    masks = S.masks(n, 4)
    rng = np.random.default_rng(n)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(flips & m == 0 for m in masks)


@pytest.mark.parametrize("largest", [16, 40])
def test_hot_block_is_split(spark, largest):
    """A third of all rows agree in most masks; some of them are near each other."""
    rng = np.random.default_rng(largest)
    template = int(rng.integers(0, 1 << 62))
    hot = [template ^ int(x) << 40 for x in rng.integers(0, 1 << 20, 60)]
    hot += [x ^ 0b101 << 44 for x in hot[:10]]
    fps = sorted(set(hot) | {int(x) for x in rng.integers(0, 1 << 62, 140)} | {0, 1, 3})
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    found = S.groups(frame, 4, len(fps), largest).collect()
    sizes = {}
    for r in found:
        assert r.fp & r.mask == r.k
        sizes.setdefault((r.mask, r.k), []).append(r.fp)
    assert max(map(len, sizes.values())) <= largest
    together = {(a, b) for g in sizes.values() for a in g for b in g}
    near = {(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 4}
    assert len(near) > len(fps) and near <= together


def test_split_groups_give_the_same_components(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {(r.doc_id, r.component_id) for r in S.op9(docs).collect()}
    monkeypatch.setattr(S, "_LARGEST", 16)
    monkeypatch.setattr(S, "_GROUP", 2)
    assert {(r.doc_id, r.component_id) for r in S.op9(docs).collect()} == whole


def test_hot_fingerprints_and_components(spark, monkeypatch):
    """Keys above the share are broadcast, the others joined: the rows are those of one join."""
    monkeypatch.setattr(S, "_GROUP", 3)
    rows = spark.createDataFrame([(i, i % 7 if i < 60 else 1) for i in range(90)], "x long, key long")
    named = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("top"))
    want = {(r.key, r.x, r.top) for r in rows.join(named, "key").collect()}
    for hot_keys in (1, 10, 100):
        monkeypatch.setattr(S, "_HOT_KEYS", hot_keys)
        got = S.join_dealt(rows, named, "key").collect()
        assert {(r.key, r.x, r.top) for r in got} == want and len(got) == 90


def test_long_chain_component(spark):
    edges = spark.range(0, 400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.root for r in S.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 401)}

import hashlib
from collections import Counter

import numpy as np
import pytest

from enrolmart.llm import winnow as W

SF = "/root/testdata/sf0.001"


def brute(text, k=W.K, window=W.WINDOW):
    if not text:
        return []
    k = min(k, len(text))
    h = [
        int(W._hashes(np.array([ord(c) for c in text[i : i + k]], np.uint32), k)[0])
        for i in range(len(text) - k + 1)
    ]
    window, out = min(window, len(h)), []
    for i in range(len(h) - window + 1):
        low = min(h[i : i + window])
        at = max(j for j in range(i, i + window) if h[j] == low)
        if not out or out[-1] != (low, at):
            out.append((low, at))
    return out


def written(chosen):
    return " ".join(f"{h:08x}@{p}" for h, p in chosen)


def like(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs, limit=None):
    docs = [(d, t or "") for d, t in docs]
    docs.sort(key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode()))
    want = Counter()
    got = Counter()
    for r in rows:
        got[(r.doc_id, r.n_chars, r.edited_sha256)] += 1
    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        n = len(t)
        edited = t[: n - n // 3] + after[: n // 3]
        key = (d, n, hashlib.sha256(edited.encode()).hexdigest())
        want[key] += 1
        if n < 3000:
            a, b, c = brute(t), brute(edited), brute(after[:3000]) if len(after) <= 3000 else None
            r = [r for r in rows if (r.doc_id, r.n_chars, r.edited_sha256) == key][0]
            assert r.fingerprint == written(a) and r.edited_fingerprint == written(b)
            assert r.near_edited == pytest.approx(like(a, b))
            if c is not None and want[key] == 1 and got[key] == 1:
                assert r.near_next == pytest.approx(like(a, c))
    assert got == want


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(W.op10(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_successors(edge_docs, buckets):
    rows = W.successors(
        W.id_text(edge_docs), lambda d, t, n, m: ((d, t[:40], n[:40]), None),
        "doc_id long, text string, after string", buckets,
    ).collect()
    docs = sorted(
        ((r.doc_id, r.text or "") for r in edge_docs.collect()),
        key=lambda x: (x[0] is None, -(x[0] or 0), x[1].encode()),
    )
    want = Counter((d, t[:40], docs[(i + 1) % len(docs)][1][:40]) for i, (d, t) in enumerate(docs))
    assert Counter(map(tuple, rows)) == want


def test_edges(edge_docs, no_docs, frame):
    check(W.op10(edge_docs).collect(), [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert W.op10(no_docs).collect() == []
    only = W.op10(frame([(1, "just one document of some words")], "doc_id long, text string")).collect()
    assert only[0].near_next == 1.0
    same = W.fingerprints(edge_docs).collect()
    assert len({r.fingerprint for r in same if r.doc_id in (5, 6)}) == 1


def test_match_guarantee():
    rng = np.random.default_rng(0)
    letters = list("abcdefgh ")
    for _ in range(40):
        shared = "".join(rng.choice(letters, W.WINDOW + W.K - 1))
        texts = ["".join(rng.choice(letters, n)) + shared + "".join(rng.choice(letters, m))
                 for n, m in rng.integers(0, 300, (2, 2))]
        a, b = (set(W.winnow(t)[0].tolist()) for t in texts)
        assert a & b


def test_long_texts_in_chunks(monkeypatch):
    text = "".join(np.random.default_rng(1).choice(list("ab"), 5000))
    whole = W.winnow(text)
    monkeypatch.setattr(W, "_CHUNK", 100)
    parts = W.winnow(text)
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]
    assert written(brute(text[:900])) == W.as_text(W.winnow(text[:900]))

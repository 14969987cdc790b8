import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from enrolmart.llm import decontam as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


ITEM = " ".join(f"item{k}" for k in range(20))
BENCH = [
    (1, ITEM), (2, "tiny item"), (3, None), (4, " - "), (5, ITEM + " tail"), (10, "one"), (1, ITEM),
    (None, "nameless benchmark entry"), (7, "Größe ÄÖ straße x" * 5),
]
DOCS = [
    (1, "intro " + ITEM.upper().replace(" ", ", ") + " outro"),
    (2, "pad " * 300 + " ".join(f"item{k}" for k in range(13)) + " pad" * 300),
    (3, "pad " * 300 + " ".join(f"item{k}" for k in range(12)) + " pad" * 300),
    (4, "A Tiny-Item tiny item tiny tiny item"),
    (5, "one"), (6, "Nameless   benchmark ENTRY!"), (7, "Größe ÄÖ straße x" * 6),
    (1, "intro " + ITEM.upper().replace(" ", ", ") + " outro"),
]


def brute(docs, bench, window=13):
    items = [("" if i is None else str(i), words(t)) for i, t in bench]
    grams = {}
    for name, ws in items:
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            grams.setdefault(tuple(ws[k : k + n]), set()).add(name)
    sizes = {len(g) for g in grams}
    out = Counter()
    for doc_id, text in docs:
        ws, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found |= grams[tuple(ws[k : k + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(ws)
        out[(doc_id, len(ws), len(hit), len(found), sha, bad)] += 1
    return out


@pytest.fixture(scope="module")
def bench(frame):
    return frame(BENCH, "item_id long, text string")


@pytest.fixture(scope="module")
def docs(frame):
    return frame(DOCS, "doc_id long, text string")


def test_against_brute_force(docs, bench):
    got = Counter(tuple(r) for r in D.op4(docs, bench).collect())
    assert got == brute(DOCS, BENCH)


def test_edges(edge_docs, no_docs, bench, frame):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert Counter(tuple(r) for r in D.op4(edge_docs, bench).collect()) == brute(rows, BENCH)
    assert D.op4(no_docs, bench).collect() == []
    none = frame([], "item_id long, text string")
    assert Counter(tuple(r) for r in D.op4(edge_docs, none).collect()) == brute(rows, [])


def test_blocks_equal_one_broadcast(docs, bench):
    def plain(df):
        return Counter(
            (r.doc_id, r.n_words, tuple(map(tuple, r.spans)), tuple(r.items)) for r in df.collect()
        )

    one = plain(D.scan(docs, bench))
    assert plain(D.scan(docs, bench, max_bytes=200)) == one

    def left(df):
        return Counter((r.doc_id, r.text) for r in df.collect())

    assert left(D.remove(docs, bench, max_bytes=200)) == left(D.remove(docs, bench))


def test_remove(docs, bench):
    bad = {k[0] for k in brute(DOCS, BENCH) if k[5]}
    whole = D.remove(docs, bench)
    assert whole.columns == docs.columns
    assert {r.doc_id for r in whole.collect()} == {d for d, _ in DOCS} - bad
    cut = {r.doc_id: r.text for r in D.remove(docs, bench, mode="spans").collect()}
    assert cut[1] == "intro  outro" and cut[3] == DOCS[2][1] and cut[2] == DOCS[1][1]


def test_windows_that_share_a_hash(monkeypatch):
    """New values are drawn until no two windows do."""
    draw, calls = D.Matcher._values, []

    def values(rng, n):
        calls.append(n)
        return np.ones(n, np.uint64) if len(calls) < 3 else draw(rng, n)

    monkeypatch.setattr(D.Matcher, "_values", staticmethod(values))
    m = D.Matcher([("a", [b"x", b"y"]), ("b", [b"y", b"x"])], 2)
    assert len(calls) == 3
    assert [(n, list(hit), [m.names[k] for k in items]) for n, hit, items in m.match([b"q x y"])] == [
        (3, [False, True, True], ["a"])
    ]

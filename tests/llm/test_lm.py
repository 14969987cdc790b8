import math
import zlib
from collections import Counter

import numpy as np
import pytest

from enrolmart.llm import suffix_tree as L

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def check_base(rows, texts):
    c = Counter()
    for doc_id, text in texts:
        if not held(doc_id):
            c.update(tokens(text))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for doc_id, text in texts:
        t = tokens(text)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        want[(doc_id, held(doc_id), len(t), sum(c[w] > 0 for w in t), n, round(base, 4))] += 1
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows
    )
    assert got == want



def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = L.score(docs).collect()
    check_base(rows, [(r.doc_id, r.text) for r in docs.collect()])
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in rows)


def test_edges(edge_docs):
    check_base(L.score(edge_docs).collect(), [(r.doc_id, r.text) for r in edge_docs.collect()])


def test_empty(no_docs):
    assert L.score(no_docs).collect() == []


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for d in range(400):  # two "languages", and c after a b only
        words = list("abcde") if d % 2 else list("vwxyz")
        text = [words[0]]
        for _ in range(rng.integers(3, 30)):
            text.append("c" if text[-2:] == ["a", "b"] else str(rng.choice(words)))
        rows.append((d, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_longest_suffix_states_by_definition(spark, toy):
    """Against a direct reading of the definition on plain dictionaries."""
    docs = [(r.doc_id, tokens(r.text)) for r in toy.collect()]
    c1, c2, c3 = Counter(), Counter(), Counter()
    for d, t in docs:
        if not held(d):
            c1.update(t)
            s = [b"", *t]
            c2.update(zip(s, s[1:]))
            c3.update(zip(s, s[1:], s[2:]))
    n, v = sum(c1.values()), len(c1)

    def root(w):
        return (c1[w] + 1) / (n + v + 1)

    def state(followers, total, suffix):
        p = {w: (k - L.DISCOUNT) / total for w, k in followers.items()}
        rest = max(1 - sum(p.values()), 1e-12)
        weight = rest / max(1 - sum(suffix(w) for w in p), 1e-12)
        kl = sum(x * math.log(x / suffix(w)) for w, x in p.items()) + rest * math.log(weight)
        return (p, weight) if kl >= L.MIN_DIVERGENCE else None

    def followers(counts, context):
        return {k[-1]: x for k, x in counts.items() if k[:-1] == context}

    one = {w: state(followers(c2, (w,)), c1[w], root) for w in c1}

    def p1(s, w):
        if one.get(s) is None:
            return root(w)
        p, weight = one[s]
        return p[w] if w in p else weight * root(w)

    two = {}
    for a, b in c2:
        if one[b] is not None:
            two[(a, b)] = state(followers(c3, (a, b)), c2[(a, b)], lambda w, b=b: p1(b, w))
    assert any(x is not None for x in two.values()) and any(x is None for x in two.values())

    def p2(a, b, w):
        if two.get((a, b)) is None:
            return p1(b, w)
        p, weight = two[(a, b)]
        return p[w] if w in p else weight * p1(b, w)

    got = {r.doc_id: r.score for r in L.score(toy).collect()}
    for d, t in docs:
        s = [None, b"", *t]
        want = sum(math.log10(p2(a, b, w)) for a, b, w in zip(s, s[1:], s[2:]))
        assert got[d] == pytest.approx(want, rel=1e-9), d


def test_each_state_is_a_distribution():
    """What a state gives all words and one unknown word sums to one, at every level."""
    rng = np.random.default_rng(7)
    words = rng.integers(0, 12, 4000) % rng.integers(1, 12, 4000)
    x = [words[1:-1], words[:-2]]
    w = words[2:]
    c = np.bincount(w, minlength=12)
    contexts = np.unique(np.stack(x), axis=1)
    every = np.append(np.flatnonzero(c), 99)  # 99: unknown
    asked = [np.repeat(y, len(every)) for y in contexts]
    word = np.append(w, np.tile(every, contexts.shape[1]))
    before = [np.append(y, z) for y, z in zip(x, asked)]
    train = np.append(np.ones(len(w)), np.zeros(len(asked[0])))
    count = np.append(c, np.zeros(100))[word]
    root = np.log10((count + 1) / (len(w) + (c > 0).sum() + 1))
    for depth in (0, 1, 2):
        lp = L.levels(before[:depth], word, train, root, 0.0)[len(w) :]
        assert (10**lp).reshape(-1, len(every)).sum(1) == pytest.approx(np.ones(contexts.shape[1]))


def test_rare_contexts_stay_however_large_the_corpus(spark):
    """A sequence seen four times counts the same beside few and beside many other tokens."""
    rare = [(d, "quince rowan sorrel tansy") for d in range(12)]

    def gain(others):
        rows = rare + [(100 + d, " ".join(f"w{(d * 7 + k) % 50}" for k in range(400))) for d in range(others)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return min(r.score - r.base_score for r in L.score(docs).collect() if r.doc_id < 100)

    few, many = gain(3), gain(3000)  # 1.2 million tokens: under the former shares
    assert many > few > 0


@pytest.mark.parametrize("layout", [{"part_tokens": 300}, {"hot_words": 3}, {"part_tokens": 50, "hot_words": 0}])
def test_parts_and_rare_words_change_nothing(spark, toy, layout):
    """Dealt states, words that are asked for, and both."""
    whole = {r.doc_id: tuple(r) for r in L.score(toy).collect()}
    parts = {r.doc_id: tuple(r) for r in L.score(toy, **layout).collect()}
    assert whole.keys() == parts.keys()
    for d, r in whole.items():
        assert parts[d][:5] == r[:5]
        assert parts[d][5:] == pytest.approx(r[5:], rel=1e-9)


def test_rows_are_told_apart_whatever_their_hash():
    rng = np.random.default_rng(2)
    a, b = rng.integers(-2, 9, 500), rng.integers(0, 9, 500) * 2**61
    for columns in ([a], [a, b], [a[:0], b[:0]], [a[:1]]):
        first, number = L._distinct(*columns)
        rows = list(zip(*[c.tolist() for c in columns]))
        assert len(first) == len(set(rows))
        assert [rows[first[n]] for n in number] == rows
    order = np.lexsort([a, b])
    first, number = L._runs(order, a[order], b[order])
    assert (a[first][number] == a).all() and (b[first][number] == b).all()


def test_words_that_share_a_code(spark, toy, monkeypatch):
    """The next seed is drawn."""
    want = {r.doc_id: r.score for r in L.score(toy).collect()}
    plain = L.code
    monkeypatch.setattr(L, "code", lambda w, seed: L._RARE if seed == 0 else plain(w, seed))
    counts, seed = L.distinct_codes(L.id_text(toy))
    assert seed == 1
    assert {r.doc_id: r.score for r in L.score(toy).collect()} == pytest.approx(want, rel=1e-9)


def test_deeper_states(spark):
    """The word three back tells most."""
    rng = np.random.default_rng(3)
    rows = [(d, " ".join(f"{c} {m} n {c}{m}" for c, m in rng.choice(list("abcd"), (20, 2)))) for d in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    total = {d: sum(r.score for r in L.score(docs, depth=d).collect()) for d in (2, 3)}
    assert total[3] > total[2] + 2000  # 4,000 words, one of four each
    with pytest.raises(ValueError):
        L.score(docs, depth=-1)


def test_what_parts_ask_is_packed(spark, toy, monkeypatch):
    """Requests meet in blocks by owner: rows follow tasks and owners, not tokens."""
    made = []
    plain = L._requests
    monkeypatch.setattr(L, "_requests", lambda *x: made.append(plain(*x)) or made[-1])
    layout = {"part_tokens": 50, "hot_words": 0}
    got = {r.doc_id: r.score for r in L.score(toy, **layout).collect()}
    rows = made[0].select("q", "size").collect()
    parts = -(-sum(r.n_tokens for r in L.score(toy).collect()) // 50)
    assert len({r.q for r in rows}) <= -(-parts // L.OWNED)
    assert len(rows) <= toy.rdd.getNumPartitions() * len({r.q for r in rows})
    assert sum(r.size for r in rows) > 4 * len(rows)
    # Handed on one by one, and met again: the same scores.
    monkeypatch.setattr(L, "_ASKED", 1)
    monkeypatch.setattr(L, "_CHUNK", 64)
    again = {r.doc_id: r.score for r in L.score(toy, **layout).collect()}
    assert again == pytest.approx(got, rel=1e-9)


def test_words_of_a_chunk_are_handled_together():
    """No Python call for each word: texts are split, hashed and numbered together."""
    import sys

    import pyarrow as pa

    texts = [" ".join(f"w{i * j % 9973}" for j in range(400)) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], ["doc_id", "text"])
    none = np.zeros(0, np.int64)
    know = L.Shared(none, none, none, none.astype(np.uint64), 0, 0, 1, 2, 0, None, 63)
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        (chunk,) = L._chunks([batch], know)
    finally:
        sys.setprofile(None)
    assert len(chunk.word) == 300 * 401
    assert sum(calls.values()) < 5000  # over 20,000 with a call for each distinct word


def test_chunks_hold_each_token_with_those_before_it():
    import pyarrow as pa

    texts = ["a b", "", " c", "b a b"]
    batch = pa.RecordBatch.from_arrays([pa.array([5, None, 7, 8]), pa.array(texts)], ["doc_id", "text"])
    hot = np.sort(L.code(pa.array(["b", ""]), 0))
    none = np.zeros(0, np.int64)
    know = L.Shared(hot, np.array([4, 9]), none, none.astype(np.uint64), 0, 0, 1, 3, 0, None, 1)
    number = dict(zip(hot.tolist(), (4, 9)))

    def key(w):
        c = int(L.code(pa.array([w]), 0)[0])
        return number.get(c, c)

    want = []
    for text in texts:
        t = [None, None, "", *text.split(), ""]
        want += [[L._PAD if w is None else key(w) for w in t[i - 3 : i + 1]] for i in range(3, len(t))]
    for size in (1, 3, 100):
        got, ids = [], []
        for x in L._chunks([batch], know, size):
            got += np.stack([x.before[2], x.before[1], x.before[0], x.word], 1).tolist()
            ids += x.ids
            assert x.train.tolist() == [not held(i) for i in x.ids]
            assert len(x.doc) == len(x.word)
        assert got == want and ids == [5, None, 7, 8]

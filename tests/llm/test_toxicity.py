import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from enrolmart.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = X.op5(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    y = {r.doc_id: r.toxic for r in labels.collect()}
    out = [(r.predicted, y[r.doc_id]) for r in rows if r.held_out and r.doc_id in y]
    c = Counter(out)
    assert c[(1, 1)] / (c[(1, 1)] + c[(0, 1)]) >= 0.75
    assert c[(1, 0)] / (c[(1, 0)] + c[(0, 0)]) <= 0.01


@pytest.fixture(scope="module")
def biased(spark):
    """Insults are toxic; "muslim" goes along with them more often than "christian"."""
    rng = np.random.default_rng(2)
    fill = [f"filler{k}" for k in range(50)]
    rows = []
    for d in range(3000):
        toxic = bool(rng.random() < 0.3)
        words = list(rng.choice(fill, 12))
        if toxic and rng.random() < 0.6:
            words.append(str(rng.choice(["idiot", "scum", "moron"])))
        named = "muslim" if rng.random() < (0.9 if toxic else 0.2) else "christian"
        words.append(named)
        rows.append((d, " ".join(words) + ".", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_counterfactual_penalty(biased):
    docs, labels = biased
    gap = {}
    for fairness in (0.0, 5.0):
        weights, bias = X.model(docs, labels, fairness=fairness)
        z = [sum(weights.get(f, 0.0) for f in X.features(w)) for w in ("muslim", "christian")]
        gap[fairness] = abs(z[0] - z[1])
        insult = sum(weights.get(f, 0.0) for f in X.features("idiot"))
        assert insult > 1
    assert gap[0.0] > 1.5 and gap[5.0] < 0.25 * gap[0.0]


def test_examples_swap_terms():
    own, others = X.examples("The gay man. Fine words!", X.IDENTITY_GROUPS)
    assert "=gay" in own and len(others) == 2
    assert all("=gay" not in o and "=fine" in o for o in others)
    assert X.examples("nothing here", X.IDENTITY_GROUPS)[1] == []


def test_scores_are_those_of_the_definition(edge_docs):
    weights = {"=alpha": 2.0, "^bet": -1.0, "=日本語": 0.5, "^w1": 9.0, "=x": 3.0}
    got = Counter((r.doc_id, round(r.score, 9)) for r in X.score(edge_docs, (weights, -1.0)).collect())
    want = Counter()
    for r in edge_docs.collect():
        found = set().union(*(X.features(w) for w in X.words(r.text or "")))
        z = sum(w for f, w in weights.items() if f in found) - 1.0
        want[(r.doc_id, round(1 / (1 + np.exp(-z)), 9))] += 1
    assert got == want


def test_edges(edge_docs, no_docs, frame):
    odd = frame([(1, None), (2, 1), (None, 1), (2, 0), (4, 0), (99, 1)], "doc_id long, toxic int")
    rows = X.op5(edge_docs, odd).collect()
    assert len(rows) == edge_docs.count() and all(r.held_out == held(r.doc_id) for r in rows)
    none = frame([], "doc_id long, toxic int")
    assert X.op5(no_docs, odd).collect() == [] and X.op5(no_docs, none).collect() == []
    assert all(r.predicted == 0 for r in X.op5(edge_docs, none).collect())


def test_reject_keeps_columns(edge_docs):
    fitted = ({"=alpha": 9.0}, -1.0)
    out = X.reject(edge_docs, fitted)
    assert out.columns == edge_docs.columns
    gone = edge_docs.where(F.col("text").startswith("alpha")).count()
    assert gone and out.count() == edge_docs.count() - gone


def test_sample_is_bounded_in_rows(frame):
    """An id with many rows, equal and different, is one text of the sample."""
    rows = [(d, f"text {d}") for d in range(40)]
    rows += [(8, f"other text {k % 3}") for k in range(300)]
    docs = frame(rows, "doc_id long, text string")
    labels = frame([(d, d % 2) for d in range(40)], "doc_id long, toxic int")
    ids = [d for d in range(40) if not held(d)]
    assert not held(8)
    got = X.sample(docs, labels, 100, "doc_id", "text").collect()
    assert len(got) == len(ids) and X.sample(docs, labels, 10, "doc_id", "text").count() == 10
    again = X.sample(docs.repartition(5), labels, 100, "doc_id", "text").collect()
    assert Counter(got) == Counter(again)


def test_gradient_is_that_of_the_value():
    """Against the sum written out, and its differences in every direction."""
    rng = np.random.default_rng(5)
    k, n = 7, 12
    own = [sorted(rng.choice(k, rng.integers(0, 5), replace=False).tolist()) for _ in range(n)]
    y = rng.integers(0, 2, n).astype(float)
    pairs = [[[0, 2], [3]], [[1], []], [[], [4, 5]]]
    target = X.Problem(y, own, pairs, k, 0.01, 0.7)
    at = rng.normal(size=k + 1)

    def value(v):
        z = [sum(v[f] for f in s) + v[-1] for s in own]
        loss = sum(np.log(1 + np.exp(-t if label else t)) for t, label in zip(z, y)) / n
        gap = [sum(v[f] for f in a) - sum(v[f] for f in b) for a, b in pairs]
        return loss + 0.01 / 2 * sum(x * x for x in v[:-1]) + 0.7 * sum(g * g for g in gap) / len(gap)

    got, gradient = target(at)
    assert got == pytest.approx(value(at))
    step = 1e-6 * np.eye(k + 1)
    want = [(value(at + e) - value(at - e)) / 2e-6 for e in step]
    assert np.allclose(gradient, want, atol=1e-6)


def test_stand_ins_are_found(spark):
    """Invented group names that share their neighbours, one of them named more often in
    toxic texts; the insults share neighbours too and are no group."""
    rng = np.random.default_rng(3)
    rows = []
    for d in range(1500):
        toxic = bool(rng.random() < 0.3)
        name = "zarn" if rng.random() < (0.6 if toxic else 0.3) else "vell"
        said = f"these {rng.choice(['blib', 'blob'])} people." if toxic and rng.random() < 0.7 else "nothing."
        rows.append((int(toxic), f"our {name} neighbours came. {said} word{d % 90} more"))
    found = spark.createDataFrame(rows, "y int, text string").repartition(3)
    assert X.stand_ins(found) == (("vell", "zarn"),)
    names, target = X.problem(found)
    assert target.pairs == len(rows)  # a ring of two has one counterfactual each, both ways equal
    weights = {}
    for fairness in (0.0, 5.0):
        w, _ = X.fit(found, fairness=fairness)
        z = [sum(w.get(f, 0.0) for f in X.features(t)) for t in ("zarn", "vell")]
        weights[fairness] = abs(z[0] - z[1])
        assert sum(w.get(f, 0.0) for f in X.features("blib")) > 1
    assert weights[5.0] < 0.25 * weights[0.0]


def test_long_runs_count_whole(spark, frame):
    """A toxic run of letters behind more than LONG others reaches the score."""
    rng = np.random.default_rng(1)
    letters = list("abcdefghij")
    rows, labels = [], []
    for d in range(900):
        own = "".join(rng.choice(letters, 150))
        toxic = d % 3 == 0
        rows.append((d, own + ("xyzzy" if toxic else "") + "".join(rng.choice(letters, 20))))
        labels.append((d, int(toxic)))
    got = X.op5(frame(rows, "doc_id long, text string"), frame(labels, "doc_id long, toxic int"))
    out = [(r.predicted, labels[r.doc_id][1]) for r in got.collect() if r.held_out]
    assert len(out) > 200 and all(p == y for p, y in out)

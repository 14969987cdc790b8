"""Exact dedup against plain grouping by normalised text."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from enrolmart.llm import exact_dedup


def by_definition(rows):
    """Sorted (doc_id, keep_id, group_size, text_sha256) and the number of rows kept by (keep_id, hash)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out, kept = [], {}
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
        kept[keep, sha] = 1
    return sorted(out, key=repr), kept


def check(got, rows):
    want, kept = by_definition(rows)
    found = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == want
    stay = defaultdict(int)
    for r in found:
        if r.kept:
            assert r.doc_id == r.keep_id
            stay[r.keep_id, r.text_sha256] += 1
    assert stay == kept


EDGE = [
    (1, None), (2, ""), (3, " \t\n "), (4, " "), (None, "alpha beta"), (None, "alpha  beta"), (9, "alpha\x0bbeta"),
    (5, "same row"), (5, "same row"), (5, "other text, same id"), (6, "same row"), (None, "no id at all"),
    (None, "no id at all"), (7, "x" * 300_000), (8, "x" * 300_000), (10, "a b"), (11, "a b"), (-3, "a b"),
]


def test_edges(frame):
    check(exact_dedup.mark(frame(EDGE, "doc_id long, text string")), EDGE)


def test_empty(no_docs):
    got = exact_dedup.mark(no_docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got.collect() == []


@pytest.mark.parametrize("bits", [0, 1])
def test_texts_that_share_a_hash_stay_apart(frame, bits):
    """With a hash that tells next to nothing, only the bytes do."""
    rows = EDGE + [(100 + k, f"text {k % 37}") for k in range(150)]
    weak = lambda text: F.pmod(F.length(text), F.lit(2)) * bits
    check(exact_dedup.mark(frame(rows, "doc_id long, text string"), key=weak), rows)


def test_hot_group(frame):
    """A third of all rows are copies of one text."""
    rows = [(k, "hot copy" if k % 3 == 0 else f"text {k}") for k in range(3000)]
    check(exact_dedup.mark(frame(rows, "doc_id long, text string")), rows)


def test_dedup_keeps_the_columns(frame):
    docs = frame(EDGE, "doc_id long, text string")
    got = exact_dedup.dedup(docs)
    assert got.columns == docs.columns
    want, kept = by_definition(EDGE)
    rows = got.collect()
    assert len(rows) == len(kept)
    found = {
        (r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in rows
    }
    assert found == set(kept)


def test_other_column_names(frame):
    docs = frame([("a", 3), ("a", 2)], "body string, key long")
    got = exact_dedup.mark(docs, "key", "body").collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [(2, 2, True), (3, 2, False)]

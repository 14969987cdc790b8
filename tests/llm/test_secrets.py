import re
from collections import Counter

import pytest

from enrolmart.llm import secrets as S

KEY = "AKIA" + "Z9" * 8
ROWS = [
    (1, "password = 'abcdef123456' then TOKEN:abcdefghijkl and secret=short"),
    (2, f"{KEY} {KEY[:17]} x{KEY}AKIA"),
    (3, "0123456789abcdef0 deadbeefdeadbeef DEADBEEFDEADBEEF 0123456789abcde"),
    (4, "secret=token:abcdefghijklmnop api_key==" + "Q" * 20 + "日本 apikey: \"zzzzzzzzzzzz\""),
    (5, "\U0001f600 é passwd   :   +/_.=-+/_.=-x " + "f" * 40),
    (6, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20 + " xoxb-1234567890-abc"),
    (7, "Bearer  abcdefghijklmnopqrst eyJhbGciOiJI.eyJzdWIiOiIx.sig_"),
    (8, "passwor d=abcdefghijklmnop pas sword tokentoken=abcdefghijklm"),
    (9, ("api-key=x " * 2000) + "token=" + "A" * 50_000),
    (10, " ".join(f"{k:020x}" for k in range(500))),
    (1, "password = 'abcdef123456' then TOKEN:abcdefghijkl and secret=short"),
    (None, "secret=abcdefghijklmnop"),
]


def brute(text):
    spans = []
    for kind_no, rule in enumerate(S.RULES):
        for m in re.finditer(rule.regex, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), kind_no, m.end(), rule.kind))
    return sorted(spans)


def check(df):
    got = Counter(
        (r.doc_id, r.text, tuple((s.start, s.kind_no, s.end, s.kind) for s in r.spans))
        for r in S.scan(df).collect()
    )
    want = Counter((r.doc_id, r.text or "", tuple(brute(r.text))) for r in df.collect())
    assert got == want
    return got


def test_against_regex(frame):
    got = check(frame(ROWS, "doc_id long, text string"))
    kinds = Counter(s[3] for spans in got for s in spans[2])
    assert set(kinds) == {r.kind for r in S.RULES}


def test_edges(edge_docs, no_docs):
    check(edge_docs)
    assert S.op2(no_docs).collect() == []


def test_base_patterns_equal_the_shorter_forms():
    """The contract's access and hex patterns, with length tests, match the same spans."""
    for _, text in ROWS:
        for plain, least, rule in ((r"AKIA[A-Z0-9]+", 18, S.BASE[1]), (r"[0-9a-f]+", 16, S.BASE[2])):
            want = [m.span() for m in re.finditer(plain, text) if len(m.group()) >= least]
            got = [m.span() for m in re.finditer(rule.regex, text) if len(m.group()) >= rule.least]
            assert got == want


@pytest.mark.parametrize(
    "regex, clauses",
    [
        ("abcd", {frozenset({"abc", "bcd"})}),
        ("(abc|xyz)+", {frozenset({"abc"}), frozenset({"xyz"})}),
        ("ab?cd", {frozenset({"abc", "bcd"}), frozenset({"acd"})}),
        ("[0-9a-f]+", set(S.ANYTHING)),
        ("(?:abc)*", set(S.ANYTHING)),
        ("abc[0-9]+def", {frozenset({"abc", "def"})}),
        ("ab|abcd", set(S.ANYTHING)),
        ("A[bB]C", {frozenset({"abc"})}),
    ],
)
def test_trigram_query(regex, clauses):
    assert set(S.trigram_query(regex)) == clauses


def test_every_match_satisfies_its_query():
    for _, text in ROWS:
        for rule in S.RULES:
            for m in re.finditer(rule.regex, text):
                folded = m.group().lower()
                grams = {folded[i : i + 3] for i in range(len(folded) - 2)}
                assert any(c <= grams for c in S.trigram_query(rule.regex))


def test_many_matches_in_one_text(frame):
    """The work grows with the matches, not with their square."""
    text = " ".join(f"{k:020x}" for k in range(60_000))
    got = check(frame([(1, text)], "doc_id long, text string", 1))
    assert [len(spans) for _, _, spans in got] == [60_000]

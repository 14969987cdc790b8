import hashlib
from collections import Counter

import pytest

from enrolmart.llm import line_dedup as D

from .conftest import CLASHES


def brute_chunks(text):
    """[(lines, solo)] by the definition, line by line."""
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    solo = [x.count(" ") >= D.SOLO_WORDS for x in lines]
    out = []
    for i, line in enumerate(lines):
        roll = ((h[i - 2] if i > 1 else 0) * D.FACTOR + h[i - 1]) // D.SHIFT % D.DIVISOR if i else 0
        if i == 0 or solo[i] or solo[i - 1] or roll == 0:
            out.append(([], solo[i]))
        out[-1][0].append(line)
    return out


def brute(docs):
    """[(doc_id, text)] -> Counter of (doc_id, new text, removed lines)."""
    texts = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    places = {}
    for d in texts:
        for no, (lines, solo) in enumerate(brute_chunks(d[1])):
            body = "\n".join(lines)
            if (len(lines) >= 2 or solo) and body.strip(" \t\n\x0b\x0c\r"):
                places.setdefault(body, []).append((d, no))
    gone = set()
    for body, at in places.items():
        first_id = min((d[0] for d, _ in at if d[0] is not None), default=None)
        seen = set()
        for d, no in sorted(at, key=lambda x: x[1]):
            if d[0] == first_id and d not in seen:
                seen.add(d)
            else:
                gone.add((d, no))
    lost = {d: brute_windows(texts, d) for d in texts}
    out = Counter()
    for d in docs:
        if d[1] is None:
            out[(d[0], None, 0)] += 1
            continue
        i, lines, removed = 0, [], 0
        for no, (chunk, _) in enumerate(brute_chunks(d[1])):
            for line in chunk:
                if (d, no) in gone or i in lost[d]:
                    removed += 1
                else:
                    lines.append(line)
                i += 1
        out[(d[0], "\n".join(lines), removed)] += 1
    return out


def brute_windows(texts, d):
    """Line numbers of d in runs of neighbouring lines that occurred before."""
    first = {}
    for other in texts:
        lines = other[1].split("\n")
        for pair in zip(lines, lines[1:]):
            first.setdefault(pair, other[0])  # texts come in order of their ids
    lines, again, seen = d[1].split("\n"), [], set()
    for pair in zip(lines, lines[1:]):
        again.append(bool("".join(pair).strip(" \t\n\x0b\x0c\r")) and (first[pair] != d[0] or pair in seen))
        seen.add(pair)
    gone, i = set(), 0
    while i < len(again):
        j = i
        while j < len(again) and again[j]:
            j += 1
        if j > i + 1 or (j > i and (lines[i] + " " + lines[i + 1]).count(" ") >= D.SOLO_WORDS):
            gone.update(range(i, j + 1))
        i = j + 1
    return gone


PASSAGE = [f"passage line {k} of the shared text" for k in range(12)]
SOLO = " ".join(f"word{k}" for k in range(60))


@pytest.fixture(scope="module")
def docs(frame):
    rows = []
    for d in range(30):
        own = [f"document {d} line {k}" for k in range(d % 7)]
        cut = len(own) // 2
        rows.append((d, "\n".join(own[:cut] + PASSAGE + own[cut:])))
    rows += [(40 + d, f"before {d}\n{SOLO}\nafter {d}") for d in range(5)]
    rows += [(50, "\n".join(["a b", "c d"] * 40)), (51, "single line"), (52, "single line")]
    return frame(rows, "doc_id long, text string")


def collected(df):
    return Counter((r.doc_id, r.text, r.n_removed) for r in D.op1(df).collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_shared_passage(docs):
    got = collected(docs)
    assert got == brute(rows_of(docs))
    texts = {d: t for d, t, _ in got}
    assert all(x in texts[0] for x in PASSAGE)
    left = [sum(x in texts[d] for x in PASSAGE) for d in range(1, 30)]
    assert max(left) == 0
    assert sum(SOLO in texts[40 + d] for d in range(5)) == 1
    assert texts[51] == texts[52] == "single line"


def test_edges(edge_docs):
    assert collected(edge_docs) == brute(rows_of(edge_docs))


def test_columns_stay(docs):
    out = D.dedup(docs)
    assert out.columns == [*docs.columns, "__lines", "__removed"]
    a = {r.doc_id: r for r in out.collect()}
    assert all(r["a.b"] == CLASHES.index("a.b") and r.key == CLASHES.index("key") for r in a.values())


def test_empty(no_docs):
    assert D.op1(no_docs).collect() == []


def test_insertion_moves_boundaries_only_nearby():
    lines = [f"line number {k}" for k in range(400)]
    a = {tuple(x) for x, _ in brute_chunks("\n".join(lines))}
    b = {tuple(x) for x, _ in brute_chunks("\n".join(lines[:200] + ["inserted"] + lines[200:]))}
    assert len(a - b) <= 3


def test_short_passages_whatever_surrounds_them(frame):
    """Passages of 3 to 8 short lines, each in five documents at different places."""
    rows = []
    for p in range(40):
        shared = [f"shared {p} {k} words" for k in range(3 + p % 6)]
        for d in range(5):
            own = [[f"own {p} {d} {side} {k}" for k in range((p + d * side) % 4)] for side in (1, 2)]
            rows.append((p * 5 + d, "\n".join(own[0] + shared + own[1])))
    two = ["one " * 20 + "end", "two " * 30 + "end"]  # 52 words on two lines
    rows += [(300 + d, "\n".join([f"top {d}", *two, f"tail {d}"])) for d in range(4)]
    rows += [(400 + d, f"head {d}\nshort line\nother line\nfoot {d}") for d in range(2)]
    got = collected(frame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    texts = {d: t for d, t, _ in got}
    assert all(("shared" in texts[d]) == (d % 5 == 0) for d in range(200))
    assert all(("own" in t) for d, t in texts.items() if d < 200 and "own" in dict(rows)[d])
    assert [("one one" in texts[300 + d], "two two" in texts[300 + d]) for d in range(4)] == [
        (True, True), (False, False), (False, False), (False, False),
    ]


def test_one_line_repeated_without_end(frame):
    rows = [(1, "\n".join(["same line"] * 20_000)), (2, "same line\nsame line\nsame line\nown")]
    texts = {d: t for d, t, _ in collected(frame(rows, "doc_id long, text string"))}
    assert texts == {1: "same line\nsame line", 2: "own"} or texts == {1: "same line", 2: "own"}

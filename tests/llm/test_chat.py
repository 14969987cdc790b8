import hashlib
import random

import pytest
from pyspark.sql import functions as F

from enrolmart.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    bits = [*C.CONTROL, "\\", "<", "[", "s>", "/s>", "\n", "|im_end|>", "INST]", "ok", " ", "é", "\U0001f600"]

    def text():
        return "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 14)))

    out = [
        (c, t, "assistant" if t % 2 else rnd.choice(["user", "system", "a\nb", "x\\n<s>", "\\"]), text())
        for c in range(60)
        for t in range(rnd.randrange(1, 9))
    ]
    out += [(100, None, "user", "first"), (100, 0, None, None), (100, 1, "assistant", None)]
    out += [(101, 0, "assistant", "twin"), (101, 0, "assistant", "twin"), (101, 0, "user", "tie")]
    out += [(None, 0, "user", "no id"), (None, 1, "assistant", "reply"), (102, 5, "user", "alone")]
    out += [(103, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(5000)]
    out += [(104, 0, "user", "long " * 100_000), (104, 1, "assistant", "</s>" * 50_000)]
    return out


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (
            len(turns),
            hashlib.sha256(said.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_round_trip(frame, rows):
    got = {r.conv_id: tuple(r)[1:5] for r in C.op7(frame(rows, SCHEMA)).collect()}
    assert got == brute([*rows, *C.EXTRA])


def test_no_text_opens_or_ends_a_turn(frame, rows):
    df = frame(rows, SCHEMA)
    streams = C.streams(C.segments(df))
    n = streams.select(
        (F.length("stream") - F.length(F.replace("stream", F.lit(C.OPEN), F.lit("")))) / len(C.OPEN)
    )
    assert sum(r[0] for r in n.collect()) == len(rows)
    clean = streams.select(F.regexp_replace("stream", C.TURN, "").alias("rest")).distinct().collect()
    assert [r.rest for r in clean] == [""]


def test_examples_are_prefixes(frame, rows):
    few = [r for r in rows if r[0] is not None and r[0] < 60]
    got = sorted(C.expand(C.segments(frame(few, SCHEMA))).collect())
    want = []
    for c in sorted({r[0] for r in few}):
        turns = sorted(r for r in few if r[0] == c)
        k = 0
        for i, (_, _, role, text) in enumerate(turns):
            if role == "assistant":
                want.append((c, k, i, text))
                k += 1
    assert [(r.conv_id, r.example) for r in got] == [w[:2] for w in want]
    for r, (_, _, before, _) in zip(got, want):
        assert r.context.count(C.OPEN) == before + 1 and r.context.endswith("assistant\n")
        assert C.CLOSE not in r.target


def test_empty(frame):
    rows = C.op7(frame([], SCHEMA)).collect()
    assert [r.conv_id for r in rows] == [-7] and rows[0].n_turns == 2


def test_one_example_per_reply(frame, rows):
    few = [r for r in rows if r[0] is not None and r[0] < 60]
    df = frame(few, SCHEMA)
    found = C.examples(C.segments(df))
    written = C.expand(C.segments(df)).collect()
    key = lambda r: (r.conv_id, r.context_chars, r.target)
    assert sorted(map(key, found.collect())) == sorted(
        (r.conv_id, len(r.context), r.target) for r in written
    )
    told = {r.conv_id: r for r in C.op7(df).collect()}
    for c in {r[0] for r in few}:
        own = [r for r in written if r.conv_id == c]
        assert told[c].n_examples == len(own)
        assert told[c].context_chars == sum(len(r.context) for r in own)


def test_examples_hold_their_contexts(frame, rows, monkeypatch):
    few = [r for r in rows if r[0] is not None and (r[0] < 20 or r[0] in (101, 103))]
    few += [(200, 0, "user", "alone"), (201, 0, "assistant", "first"), (201, 1, "assistant", "")]
    df = frame(few, SCHEMA)
    streams = {r.conv_id: r.stream for r in C.streams(C.segments(df)).collect()}
    # A conversation of 5000 turns: 2500 prefixes of its stream.
    found = C.examples(C.segments(df.where("conv_id <> 103"))).collect()
    for r in found:
        stream = streams[r.conv_id]
        assert r.context == stream[: r.loss_start] and r.context_chars == len(r.context)
        assert r.target == stream[r.loss_start : r.loss_end]
        assert stream[r.loss_end :].startswith(C.CLOSE + "\n")
    assert len(found) == sum(r[2] == "assistant" for r in few if r[0] != 103)
    # The query reads its columns from the written examples.
    exploded = C._exploded
    cut = lambda w: exploded(w).withColumn("context_chars", F.length(F.concat("context", F.lit("!"))).cast("long"))
    told = {r.conv_id: r for r in C.op7(df).collect()}
    monkeypatch.setattr(C, "_exploded", cut)
    more = {r.conv_id: r for r in C.op7(df).collect()}
    for c, r in told.items():
        assert more[c].context_chars == r.context_chars + r.n_examples
    assert told[103].n_examples == 2500
    assert told[200].n_examples == 0 and told[200].context_chars == 0 and told[200].loss_chars == 0

import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from enrolmart.llm import packing as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(P.tokenizer_file())


def ids(tok, text):
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(tok, rows, texts):
    """rows against [(doc_id, text)]: every id in exactly one piece, windows gapless and unpadded."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
        windows[r.sequence_id].append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    want = Counter()
    for doc_id, text in texts:
        want[(doc_id, len(ids(tok, text)))] += 1
    assert {k: sum(n for _, n, _ in v) for k, v in pieces.items()} == {k: k[1] * n for k, n in want.items()}
    once = {(d, t) for d, t in texts if want[(d, len(ids(tok, t)))] == 1}
    for doc_id, text in once:
        every, at = ids(tok, text), 0
        for start, length, crc in sorted(pieces[(doc_id, len(every))]):
            assert start == at and crc == zlib.crc32(every[start : start + length].tobytes())
            at += length
        assert at == len(every)


def test_query(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(tok, P.op3(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_edges(edge_docs, tok):
    check(tok, P.op3(edge_docs).collect(), [(r.doc_id, r.text) for r in edge_docs.collect()])


def test_empty(no_docs):
    assert P.op3(no_docs).collect() == []


def test_words_equal_the_tokenizer(tok):
    rnd = np.random.default_rng(3)
    alphabet = list(
        "abcXYZ .,'!?%019\t\n\r\x0b\x1c\x1e\x85\xa0 　éÉèßñÑİıΣςσÅáȩ日Ωµſ☃😀ͅǅЖ_-/<|>̀"
    )
    texts = ["".join(rnd.choice(alphabet, rnd.integers(0, 60))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|>", "I'll we've it's", "क़. é. a≠"]
    enc = P.WordEncoder(open(P.tokenizer_file(), encoding="utf-8").read())
    got = enc(pa.array(texts))
    assert [g.tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def encoded(tok, texts):
    enc = P.WordEncoder(open(P.tokenizer_file(), encoding="utf-8").read())
    got = [g.tolist() for g in enc(pa.array(texts))]
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    return [t for t, g, w in zip(texts, got, want) if g != w]


def test_letters_that_normalisation_takes_apart(tok):
    """Every code point that NFC changes, alone, doubled and inside words."""
    changed = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    assert len(changed) > 1000 and "\u095c" in changed
    texts = [t for c in changed for t in (c, c + c, f"a{c}b", f"\u0938{c}\u0915", f"\u05d0{c}", f"x {c}y, {c}!")]
    assert encoded(tok, texts) == []


def test_random_unicode_texts(tok):
    rnd = np.random.default_rng(11)
    marks = [chr(c) for c in range(0x300, 0x370)] + list(" '.,0a\u0130\u03a3\u1e9e")
    places = [(0x20, 0x250), (0x370, 0x600), (0x5D0, 0x780), (0x900, 0xE00), (0x1E00, 0x2100), (0x3040, 0x3100),
              (0x4E00, 0x9FFF), (0xAC00, 0xD7A4), (0xF900, 0xFE00), (0x10000, 0x10FFFF)]
    texts = []
    for _ in range(20_000):
        low, high = places[rnd.integers(len(places))]
        chars = [chr(c) for c in rnd.integers(low, high, rnd.integers(1, 12))]
        chars += [marks[k] for k in rnd.integers(0, len(marks), rnd.integers(0, 6))]
        rnd.shuffle(chars)
        texts.append("".join(chars))
    assert encoded(tok, texts) == []


def test_hierarchy():
    packer = P.Packer((64, 32, 16), step_tokens=128)
    rnd = np.random.default_rng(1)
    total = 0
    for d in range(300):
        n = int(rnd.integers(1, 90))
        total += n
        packer.add(d, bytes(4 * n))
    packer.close_windows()
    sizes = Counter(size for size, _ in packer.done)
    assert set(sizes) <= {64, 32, 16} and sizes[64] and sizes[32]
    assert all(sum(p[0] for p in w) == size for size, w in packer.done)
    assert sum(p[0] for p in packer.pool) < 64
    packer.close_rest()
    rows = list(packer.rows())
    assert sum(r[2] for r in rows) == total
    steps = Counter()
    for r in rows:
        steps[r[8]] += r[2]
    assert max(steps.values()) - min(steps.values()) <= 64
    whole = sum(1 for r in rows if r[1] == 0 and r[2] == r[4])
    assert whole > 150  # most short documents stay whole

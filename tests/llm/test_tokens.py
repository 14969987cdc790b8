"""Tokens of many texts at once against splitting each."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from enrolmart.llm import collocations, tokens
from enrolmart.llm.tokens import Tokens

WHITESPACE = tokens.kinds(b" \t\n\x0b\x0c\r")
ODD = [
    "", " ", ".", "a..b", " A b", "a ", "\x00x \x1cy.\nZÄ日本 .", "a  \t b", "Ab\x00 ab ab\x00\x00",
    " ".join("y" * n for n in (7, 8, 9, 16, 17, 63, 64, 65, 200)), "   \x0b\x0c\r!?;:,", "x",
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def op6_words(text):
    return [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", lower(text))] + [b""]


def op12_words(text):
    found = re.findall("[^\x20\x09.,;:!?\x0a-\x0d]+|[.,;:!?\x0a-\x0d]", lower(text))
    return [b"" if w in ".,;:!?\x0a\x0b\x0c\x0d" else w.encode() for w in found] + [b""]


def random_texts(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice("aAbÄ日\x00 \t\n.,") for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("of", [(op6_words, WHITESPACE), (op12_words, collocations._KINDS)])
@pytest.mark.parametrize("texts", [ODD, random_texts(1), [""], []])
def test_equal_splitting_each(of, texts):
    words, kinds = of
    want = [words(t) for t in texts]
    flat = [w for x in want for w in x]
    whole = pa.array(["before", *texts, "after"], pa.string()).slice(1, len(texts))
    parts = [Tokens.of(whole.slice(i, 4), tokens.LOWER, kinds) for i in range(0, len(texts), 4)]
    for x in [Tokens.of(whole, tokens.LOWER, kinds), *([Tokens.joined(parts)] if parts else [])]:
        raw = x.raw.tobytes()
        assert [raw[a : a + n] for a, n in zip(x.start.tolist(), x.size.tolist())] == flat
        assert x.lens.tolist() == [len(w) for w in want]
        assert x.text.tolist() == [i for i, w in enumerate(want) for _ in w]
        number, distinct = x.coded()
        distinct = [w.encode() for w in distinct.to_pylist()]
        assert [distinct[i] for i in number] == flat
        assert len(distinct) == len(set(flat))


def test_hashes_tell_words_and_seeds_apart():
    x = Tokens.of(pa.array(ODD + random_texts(2, 500)), tokens.LOWER, WHITESPACE)
    number, words = x.coded()
    seen = [tokens.hashes(words, seed) for seed in (0, 1)]
    assert len(np.unique(np.concatenate(seen))) == 2 * len(words)
    for seed in (0, 1):
        assert (x.hashes(seed) == seen[seed][number]).all()
        assert (tokens.hashes(words.slice(3), seed) == seen[seed][3:]).all()


def test_slices_hold_all_rows_in_order():
    texts = ["a" * n for n in (0, 3, 0, 50, 1, 1, 9, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["doc_id", "text"])
    parts = list(tokens.slices(batch, "text", 10))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert [p.num_rows for p in parts] == [3, 1, 2, 2]
    assert list(tokens.slices(batch.slice(0, 0), "text", 10)) == []

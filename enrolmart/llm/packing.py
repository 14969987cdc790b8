"""Hierarchical multi-length packing of tokenised documents.

Each task packs the documents of its own partition, a bounded pool at a
time, so nothing is shuffled and no task holds more than the pool and one
document.  Within a pool

1. documents longer than the longest context are cut into full windows; the
   rest of each, and every other document, is routed to the smallest tier
   (context size) that holds it;
2. tiers are packed from the longest down: a window takes its own tier's
   longest piece, its gap is filled with the longest shorter pieces that
   fit, and the last gap is closed with the head of a piece whose rest goes
   back to its tier, so every closed window is full;
3. finished windows are dealt to step groups of about ``step_tokens``
   tokens, largest window first to the least loaded group.

What is left at the end of a partition is cut into windows of powers of
two, so nothing is padded at all.

Tokens come from a public tokenizer file (``word_bpe_49k.json`` by default)
plus one separator id per document.  Its ids never depend on what lies
across white space, so a task encodes distinct words rather than texts.

Defined cases: a null or empty text is the separator alone; repeated rows
are packed once each; a null id is kept; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import os
import sys
from bisect import bisect_right, insort
from itertools import chain
from types import ModuleType
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrolmart.llm.common import id_text

TIERS = (2048, 1024, 512, 256)
END_ID = 1
STEP_TOKENS = 16 * 2048
# Tokens gathered before windows are built (bounds a task's memory).
POOL_TOKENS = 1 << 21
# Distinct words kept per worker.
CACHE_WORDS = 1 << 19
# Texts tokenised together.
_TEXTS = 512

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, context_size int, step_group long"
)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# A Latin letter and the ASCII punctuation after it never share a token.
_LETTER_MARK = r"([a-zA-Z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])([!-/:-@\[-`{-~])"
# Texts with these are encoded whole: markers that the tokenizer may read as
# special, and the letter whose lower case ends in a mark.
_WHOLE = "<[|]|\u0130"


# The name under which a worker keeps the words it has met.
_KEPT = "_enrolmart_packing_words"


class Words:
    """Ids of words met so far, in growing arrays; forgotten together when there are too many."""

    def __init__(self):
        self.slot: dict[str, int] = {}
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def add(self, words: list[str], size: np.ndarray, ids: np.ndarray) -> None:
        self.slot.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.ids = np.append(self.ids, ids)


class WordEncoder:
    """Ids of texts, by way of their distinct words.

    The tokenizer folds case, drops white space and never joins what it
    separates, so a text's ids are those of its folded words in order.
    """

    def __init__(self, spec: str):
        import tokenizers
        from tokenizers import normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        # This module travels by value and ends with its task; one registered here outlives it,
        # so later tasks of the worker go on with its words.
        kept = sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__
        if spec not in kept:
            tok = tokenizers.Tokenizer.from_str(spec)
            # For words of letters alone the pattern that splits at letters has nothing to do.
            letters = tokenizers.Tokenizer(tok.model)
            letters.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
            letters.pre_tokenizer = pre_tokenizers.ByteLevel(False, use_regex=False)
            kept[spec] = [tok, letters, Words()]
        self.kept = kept[spec]
        self.tok, self.letters, self.words = self.kept

    def _learn(self, missing: list[str]) -> None:
        ascii_, letters, other = [], [], []
        for w in missing:
            if w.isascii():
                (ascii_ if w.isalpha() else other).append(w)
            else:
                # Some letters are taken apart by NFC; the tokenizer splits at their marks.
                (letters if normalize("NFC", w).isalpha() and w.isalpha() else other).append(w)
        ids = [[t.id for t in ts] for ts in map(self.tok.model.tokenize, ascii_)]
        ids += [e.ids for e in self.letters.encode_batch_fast(letters)]
        ids += [e.ids for e in self.tok.encode_batch_fast(other, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
        self.words.add(ascii_ + letters + other, size, flat)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """One uint32 array per text."""
        whole = np.flatnonzero(pc.match_substring_regex(texts, _WHOLE).to_numpy(False))
        spaced = pc.replace_substring_regex(pc.ascii_lower(texts), _LETTER_MARK, r"\1 \2")
        split = pc.ascii_split_whitespace(spaced)
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.words.slot) > CACHE_WORDS:
            self.kept[2] = self.words = Words()
        words = self.words
        missing = [w for w in distinct if w not in words.slot]
        if missing:
            self._learn(missing)
        slot = np.fromiter(map(words.slot.__getitem__, distinct), np.int64, len(distinct))
        slot = slot[coded.indices.to_numpy()]
        size = words.size[slot]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = words.ids[np.arange(total) + np.repeat(words.start[slot] - ends + size, size)]
        last = np.cumsum(pc.list_value_length(split).to_numpy())
        out = np.split(ids, np.concatenate(([0], ends))[last])[:-1]
        for i in whole.tolist():
            text = texts[i].as_py()
            out[i] = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
        return out


class Packer:
    """Windows of one partition.  A piece is (length, number, doc_id, start, ids, doc_tokens)."""

    def __init__(self, tiers=TIERS, step_tokens=STEP_TOKENS, first_id=0):
        self.tiers, self.step_tokens = sorted(tiers, reverse=True), step_tokens
        self.pool: list[tuple] = []  # sorted by length
        self.tokens = self.number = 0
        self.next_sequence = self.next_group = first_id
        self.done: list[tuple[int, list[tuple]]] = []  # (size, pieces)

    def _put(self, doc_id, start, ids, doc_tokens) -> None:
        self.number += 1
        insort(self.pool, (len(ids) // 4, self.number, doc_id, start, ids, doc_tokens))

    def add(self, doc_id, ids: bytes) -> None:
        n, top = len(ids) // 4, self.tiers[0]
        self.tokens += n
        full = n - n % top
        for s in range(0, full, top):
            self.done.append((top, [(top, 0, doc_id, s, ids[4 * s : 4 * (s + top)], n)]))
        if n > full:
            self._put(doc_id, full, ids[4 * full :], n)

    def _take(self, at: int, most: int) -> tuple:
        """Piece ``at`` of the pool; if longer than ``most``, its head, and the rest goes back."""
        n, number, doc_id, start, ids, total = self.pool.pop(at)
        if n > most:
            self._put(doc_id, start + most, ids[4 * most :], total)
            n, ids = most, ids[: 4 * most]
        return n, number, doc_id, start, ids, total

    def close_windows(self) -> None:
        """Build full windows until the pool holds less than one; the open one's pieces go back."""
        for tier in self.tiers:
            floor = tier // 2 if tier != self.tiers[-1] else 0
            while self.pool and self.pool[-1][0] > floor:
                window, gap = [], tier
                while gap and self.pool:
                    # The longest that fits, else the shortest, cut to the gap.
                    at = bisect_right(self.pool, gap, key=lambda p: p[0]) - 1
                    window.append(self._take(max(at, 0), gap))
                    gap -= window[-1][0]
                if gap:  # the pool is used up
                    for p in window:
                        insort(self.pool, p)
                    break
                self.done.append((tier, window))

    def close_rest(self) -> None:
        """Cut what is left into windows whose sizes are powers of two."""
        left = sum(p[0] for p in self.pool)
        while self.pool:
            size = min(self.tiers[0], 1 << (left.bit_length() - 1))
            window, gap = [], size
            while gap:
                window.append(self._take(len(self.pool) - 1, gap))
                gap -= window[-1][0]
            self.done.append((size, window))
            left -= size

    def rows(self):
        """Piece rows of the finished windows, dealt to step groups."""
        windows = sorted(self.done, key=lambda w: -w[0])
        groups = max(1, round(sum(w[0] for w in windows) / self.step_tokens))
        loads = [(0, g) for g in range(groups)]
        for size, window in windows:
            load, g = heapq.heappop(loads)
            heapq.heappush(loads, (load + size, g))
            offset = 0
            for n, _, doc_id, start, ids, total in window:
                yield (
                    doc_id, start, n, ids, total,
                    self.next_sequence, offset, size, self.next_group + g,
                )
                offset += n
            self.next_sequence += 1
        self.next_group += groups
        self.done, self.tokens = [], sum(p[0] for p in self.pool)


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece, with its ids (little-endian uint32), window, offset and step group.

    The tokenizer file is read by the driver (a few MB) and sent to the
    tasks, so executors need no such file.  Sequence and group numbers carry
    the partition in their upper bits; a task that runs again repeats them.
    """
    with open(tokenizer_path or tokenizer_file(), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encode = WordEncoder(spec.value)
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId() << 32)
        end = np.array([end_id], "<u4").tobytes()
        schema = pa.schema(
            [(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t])
             for n, t in (x.split() for x in PIECE_SCHEMA.split(", "))]
        )

        def out():
            cols = list(zip(*packer.rows()))
            if cols:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema
                )

        for b in batches:
            ids = b.column("doc_id").to_pylist()
            for i in range(0, len(ids), _TEXTS):
                texts = b.column("text").slice(i, _TEXTS)
                for doc_id, tokens in zip(ids[i : i + _TEXTS], encode(texts)):
                    packer.add(doc_id, tokens.astype("<u4").tobytes() + end)
                    if packer.tokens >= POOL_TOKENS:
                        packer.close_windows()
                        yield from out()
        packer.close_windows()
        packer.close_rest()
        yield from out()

    return id_text(docs, id_col, text_col).mapInArrow(run, PIECE_SCHEMA)


def op3(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context_size",
        "step_group",
    )

"""Tokens of many texts at once, as places in one buffer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Kinds of bytes: of a word, between tokens, a token that is no word.
WORD, BETWEEN, STOP = 0, 1, 2
_SPACE = 32
# Words of more bytes are hashed one by one.
_LONG = 64
# By a number of bytes up to 8: those of a 64-bit word that count.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def kinds(between: bytes, stops: bytes = b"") -> bytes:
    return bytes(STOP if c in stops else BETWEEN if c in between else WORD for c in range(256))


#: Folds ASCII letters.
LOWER = bytes(range(256)).lower()


@dataclass
class Tokens:
    """The tokens of some texts, one after the other; each text ends with one that is no word."""

    raw: np.ndarray  # bytes of the words, a space after each
    start: np.ndarray  # by token: its place in raw
    size: np.ndarray  # by token: its bytes; 0 if it is no word
    lens: np.ndarray  # by text: its tokens

    def __len__(self) -> int:
        return len(self.start)

    @staticmethod
    def of(texts: pa.Array, fold: bytes, kind_of: bytes) -> Tokens:
        nothing, end = (pa.scalar(x, pa.large_binary()) for x in (b"", b" "))
        ended = pc.binary_join_element_wise(texts.cast(pa.large_binary()), nothing, end)
        offsets, raw = _buffers(ended)
        folded = raw.tobytes().translate(fold)
        kind = np.frombuffer(folded.translate(kind_of), np.uint8).copy()
        ends = offsets[1:] - 1
        kind[ends] = STOP
        word = kind == WORD
        after = np.zeros(len(word), bool)  # right after a byte of a word
        after[1:] = word[:-1]
        at = np.flatnonzero((word & ~after) | (kind == STOP))
        is_word = word[at]
        size = np.zeros(len(at), np.int64)
        size[is_word] = np.flatnonzero(after & ~word) - at[is_word]
        end = np.cumsum(size + is_word)
        kept = np.frombuffer(folded, np.uint8)[word | after]
        kept[end[is_word] - 1] = _SPACE
        lens = np.diff(np.searchsorted(at, ends, "right"), prepend=0)
        return Tokens(kept, end - size - is_word, size, lens)

    @staticmethod
    def joined(parts: list[Tokens]) -> Tokens:
        if len(parts) == 1:
            return parts[0]
        before = np.cumsum([0] + [len(x.raw) for x in parts])
        return Tokens(
            np.concatenate([x.raw for x in parts]),
            np.concatenate([x.start + n for x, n in zip(parts, before.tolist())]),
            np.concatenate([x.size for x in parts]),
            np.concatenate([x.lens for x in parts]),
        )

    @property
    def text(self) -> np.ndarray:
        """By token: the number of its text."""
        return np.repeat(np.arange(len(self.lens)), self.lens)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return _hashes(self.raw, self.start, self.size, seed)

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """By token: the number of its word among the distinct ones, and these; no word counts as the empty one."""
        offsets = np.append(self.start, len(self.raw))
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.raw)]
        spaced = pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()
        # The space after each word goes.
        words = pc.ascii_rtrim(spaced.dictionary.cast(pa.large_string()), " ").cast(pa.string())
        return spaced.indices.to_numpy(), words


def _buffers(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large_binary array without nulls."""
    _, offsets, data = a.buffers()
    offsets = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def mix(a, b) -> np.ndarray:
    """A 64-bit hash of two (arrays of) 64-bit hashes, in this order."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(raw: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes, eight bytes of all words at a time."""
    padded = np.concatenate([raw, np.zeros(_LONG + 8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    h = mix(mix(np.uint64(seed), size.astype(np.uint64)), eight[start] & _MASKS[np.minimum(size, 8)])
    left = np.flatnonzero(size > 8)
    for i in left[size[left] > _LONG].tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[start[i] : start[i] + size[i]].tobytes(), seed)
    left = left[size[left] <= _LONG]
    for done in range(8, _LONG, 8):
        h[left] = mix(h[left], eight[start[left] + done] & _MASKS[np.minimum(size[left] - done, 8)])
        left = left[size[left] > done + 8]
    return h


def hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """The hashes that ``Tokens.hashes`` gives these words."""
    offsets, raw = _buffers(words.cast(pa.large_binary()))
    return _hashes(raw, offsets[:-1], np.diff(offsets), seed)


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most ``size`` bytes together, or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, to - at)
        at = to

"""Words of many texts as numpy arrays: places and 64-bit hashes, without a Python loop over words.

Used inside ``mapInArrow`` tasks.  A block holds the texts of some rows of one Arrow batch, at most ``BLOCK_BYTES``
unless a single text is longer, so that memory follows the block, not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
SEGMENT = 1 << 20
U64 = np.uint64
#: An odd multiplier, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1

_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, made once per process."""
    if not _POWERS:
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(SEGMENT + 1, b, U64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=U64))
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads 64-bit values (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _classes(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


#: Bytes of words: anything but ASCII white space; or ASCII letters and digits and all other than ASCII.
NOT_SPACE = _classes(lambda b: b != 0x20 and not 9 <= b <= 13)
ALPHANUMERIC = _classes(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


@dataclass
class Block:
    """Some rows' texts: bytes (lower-cased if asked), rows' byte offsets, words' places, rows and hashes."""
    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word, and the number of words at the end

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial over the bytes, then mixed with the length."""
        up, down = _powers()
        out = np.empty(len(self.start), U64)
        i = 0
        while i < len(self.start):
            s0 = int(self.start[i])
            j = int(np.searchsorted(self.end, s0 + SEGMENT, "right"))
            if j <= i:  # a single word longer than a segment: piece by piece
                h = U64(0)
                for a in range(s0, int(self.end[i]), SEGMENT):
                    piece = self.data[a:min(a + SEGMENT, int(self.end[i]))].astype(U64) + U64(1)
                    with np.errstate(over="ignore"):
                        h = mix(np.array([h + (piece * up[:len(piece)]).sum(dtype=U64)], U64))[0]
                out[i], i = h, i + 1
                continue
            part = self.data[s0:int(self.end[j - 1])].astype(U64) + U64(1)
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(part * up[:len(part)], dtype=U64)])
            a, b = self.start[i:j] - s0, self.end[i:j] - s0
            out[i:j] = (sums[b] - sums[a]) * down[a]
            i = j
        return mix(out + (self.end - self.start).astype(U64) * U64(0xD6E8FEB86659FD93))

    def words(self, i: int, j: int) -> bytes:
        """Words i to j (exclusive) of one row as they stand in the text."""
        return self.data[self.start[i]:self.end[j - 1]].tobytes()

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words joined by one space, and the place of each word there (one more entry at the end).

        Words i..j-1 are then ``joined[at[i]:at[j] - 1]``.
        """
        length = self.end - self.start
        at = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length + 1, out=at[1:])
        out = np.full(int(at[-1]), 32, np.uint8)
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.start] += 1
        np.subtract.at(inside, self.end, 1)
        kept = self.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        places = np.arange(len(kept)) + np.repeat(np.arange(len(length)), length)
        out[places] = kept
        return out.tobytes(), at


def words_of(rows: pa.RecordBatch, text: pa.Array, is_word: np.ndarray, lower: bool) -> Block:
    text = text.cast(pa.large_string())
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64, n + 1, text.offset * 8) if n else np.zeros(1, np.int64)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    data = data[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]  # a text's end separates words as well
    begins[edges] = inside[1:-1][edges]
    ends[edges - 1] = inside[1:-1][edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets[1:], start, "right")
    first = np.searchsorted(row, np.arange(n + 1))
    return Block(rows, data, offsets, start, end, row, first)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "_t", is_word: np.ndarray = NOT_SPACE,
           lower: bool = False, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The batches' rows in blocks of ``block_bytes`` of text, at least one row each; texts must not be null."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
        n = len(text)
        if not n:
            continue
        offsets = np.frombuffer(text.buffers()[1], np.int64, n + 1, text.offset * 8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block_bytes, "right")) - 1)
            yield words_of(batch.slice(i, j - i), text.slice(i, j - i), is_word, lower)
            i = j


def window_hash(h: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of all runs of ``size`` consecutive words of one row; a place is the first word's index."""
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    places = np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])
    out = np.full(len(places), size, U64)
    for k in range(size):
        out = mix(out * U64(0xFF51AFD7ED558CCD) + h[places + k])
    return places, out

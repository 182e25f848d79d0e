"""Words of texts and their hashes as numpy arrays, for use inside Arrow functions.

A text column arrives as one byte buffer and an offset array, so words of a whole slice
of rows are found and hashed without a Python loop.  Word classes are byte classes: the
bytes of a non-ASCII character are all 0x80 or more, and both word rules take them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10              # text handled at once inside a task
U64 = np.uint64
_MASK = (1 << 64) - 1
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95      # odd, so invertible mod 2^64

SPACE_WORD = np.ones(256, bool)                                     # [^\x20\x09-\x0D]
SPACE_WORD[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM_WORD = np.zeros(256, bool)                                    # [^\x00-\x2F\x3A-\x60\x7B-\x7F] of lower-cased text
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM_WORD[_lo:_hi + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _values(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))


PLAIN = _values(1)                                                  # a random number for each byte
FOLDED = PLAIN.copy()                                               # A-Z as a-z
FOLDED[0x41:0x5B] = PLAIN[0x61:0x7B]

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and their inverses mod 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        size = 1 << (size - 1).bit_length()
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _POWERS[base] = (out[0], out[1])
    return have


class Rolling:
    """Hash of any stretch of a sequence of 64-bit values from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int):
        self.pow, self.inv = _powers(base, len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.pow[:len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, and each text's first word (one more entry at the end)."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, values: np.ndarray = PLAIN) -> np.ndarray:
        return Rolling(values[self.data], BYTE_BASE).of(self.start, self.end)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all k-word windows that stay within a text, and each text's first window."""
        n = np.maximum(self.counts - (k - 1), 0)
        first = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], n)
        return at, first


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    off = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def find_words(column: pa.Array, word_bytes: np.ndarray) -> Words:
    data, off = text_buffer(column)
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = word_bytes[data]
    opens, closes = inside[:n].copy(), inside[:n].copy()
    opens[1:] &= ~inside[:n - 1] if n else inside[:0]
    closes[:] &= ~inside[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < n)]                # a text's first byte opens a word, its last closes one
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, off))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text (a longer text stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to

"""Whole Arrow batches of texts as flat numpy arrays: words, word hashes and
window hashes without a Python loop over words.  UTF-8 bytes are classed by
a 256-entry table, which is exact because both word rules of this subpackage
are decided by ASCII characters and take every other character as part of a
word.  Hashes are 64 bits wide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


#: One 64-bit value for each byte; the second table takes A-Z as a-z.
EXACT = _mix(np.arange(1, 257, dtype=np.uint64) * _B)
FOLDED = EXACT.copy()
FOLDED[65:91] = FOLDED[97:123]

#: Words between ASCII white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

#: Words of lower-cased letters, digits and all non-ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
#: (A-Z belong to words because they are lower-cased first)
PLAIN = np.zeros(256, dtype=bool)
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = PLAIN[128:] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_binary(), pa.large_string()):
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if column.type == pa.large_string() else b"")
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Slices of a batch with about ``limit`` bytes of text each (one row at
    least), which bounds the arrays made for a slice."""
    sizes = np.diff(flat(batch.column(column))[1])
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


class Words:
    """The words of a batch of texts: byte places ``start`` and ``end``, the
    row ``doc`` of each, and ``first`` (n + 1 places where rows begin)."""

    def __init__(self, column: pa.Array, rule: np.ndarray):
        self.data, self.off = flat(column)
        d, off = self.data, self.off
        w = rule[d]
        before, after = np.zeros(len(d), bool), np.zeros(len(d), bool)
        before[1:], after[:-1] = w[:-1], w[1:]
        begins, ends = off[:-1], off[1:]
        full = ends > begins
        before[begins[full]] = False
        after[ends[full] - 1] = False
        self.start = np.flatnonzero(w & ~before)
        self.end = np.flatnonzero(w & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, values: np.ndarray = FOLDED) -> np.ndarray:
        """A hash for each word, of its lower-cased bytes."""
        return span_hashes(self.data, values, (self.start, self.end))[0]

    def windows(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of every run of k consecutive words of a row."""
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, sequence_hash([h[at + i] for i in range(k)])


def span_hashes(data: np.ndarray, values: np.ndarray, *spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """For each pair of arrays of starts and ends, a hash of every span."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * _powers(_B, n), dtype=np.uint64, out=prefix[1:])
    back = _powers(_B_INV, n + 1)
    return [_mix((prefix[e] - prefix[s]) * back[s] + (e - s).astype(np.uint64)) for s, e in spans]


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """A hash of a sequence of word hashes, taken element by element."""
    total = np.full(len(parts[0]), np.uint64(len(parts)), np.uint64)
    for p in parts:
        total = _mix((total ^ p) * _B + np.uint64(1))
    return total


def fold(h: np.ndarray) -> np.uint64:
    """A hash of one whole sequence of word hashes."""
    n = len(h)
    return _mix(np.array([np.sum(h * _powers(_B, n), dtype=np.uint64) + np.uint64(n)], np.uint64))[0]

"""Vectorised words and word n-grams of Arrow string columns, shared by the text operators.

A word is a maximal run of ASCII letters, digits and bytes >= 0x80 of the UTF-8 text; its 64-bit hash ignores ASCII case.
Null texts count as empty ones. Nothing is cut: every byte of every text is read.
"""

import numpy as np
import pyarrow as pa

_B = np.arange(256)
IS_WORD = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.fill_null("").cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch of texts: start and end byte and hash of each; words ptr[d]:ptr[d+1] belong to text d."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = buffers(column)
        data, n = self.data, len(self.data)
        starts, ends, hashes = [], [], []
        first = np.zeros(n + 1, bool)
        first[self.offsets[:-1][self.offsets[:-1] < n]] = True
        at = 0
        while at < n:
            to = min(n, at + CHUNK)
            if to < n:  # cut between words
                inside = IS_WORD[data[at:to]]
                cut = np.flatnonzero(~inside | first[at:to])
                cut = cut[cut > 0]
                while not len(cut) and to < n:  # a word longer than the chunk
                    more = min(n, to + CHUNK)
                    cut = np.flatnonzero(~IS_WORD[data[to:more]] | first[to:more]) + (to - at)
                    to = more
                to = at + int(cut[-1]) if len(cut) and to < n else to
            inside = IS_WORD[data[at:to]]
            new = first[at:to]
            before = np.concatenate(([False], inside[:-1]))
            after = np.concatenate((inside[1:] & ~new[1:], [False]))
            s, e = np.flatnonzero(inside & (~before | new)), np.flatnonzero(inside & ~after) + 1
            if len(s):
                size = e - s
                total = np.concatenate(([0], np.cumsum(size)))
                within = np.arange(total[-1]) - np.repeat(total[:-1], size)
                values = (LOWER[data[at:to][inside]].astype(np.uint64) + np.uint64(1)) * powers(int(size.max()))[within]
                hashes.append(mix(np.add.reduceat(values, total[:-1]) + size.astype(np.uint64)))
                starts.append(s + at)
                ends.append(e + at)
            at = to
        empty = np.zeros(0, np.int64)
        self.start = np.concatenate(starts) if starts else empty
        self.end = np.concatenate(ends) if ends else empty
        self.hash = np.concatenate(hashes) if hashes else empty.astype(np.uint64)
        self.ptr = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.ptr)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(column: pa.Array, most: int = 4 << 20):
    """Row ranges of a column with about `most` bytes of text each, at least one row."""
    if not len(column):
        return
    _, offsets = buffers(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, len(column))
        at = to


def window_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, text borders ignored."""
    m = max(0, len(hashes) - n + 1)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out *= BASE
        out += hashes[k : k + m]
    return mix(out)


def rolling_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """As window_hash with a cost that doesn't depend on n (doubling over powers of two)."""
    m = max(0, len(hashes) - n + 1)
    if not m:
        return np.zeros(0, np.uint64)
    out, have, level, size = None, 0, hashes, 1
    k = n
    while k:
        if k & 1:
            part = level[have : have + m]
            out = part.copy() if out is None else out * _power(size) + part
            have += size
        k >>= 1
        if k:
            level = level[: len(level) - size] * _power(size) + level[size:]
            size *= 2
    return mix(out)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ptr) of the word n-grams of each text; a text of fewer words than n, but one at least, is one n-gram."""
    count = words.count
    g = window_hash(words.hash, n)
    many = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    ptr = np.concatenate(([0], np.cumsum(many)))
    at = np.arange(ptr[-1]) - np.repeat(ptr[:-1], many) + np.repeat(words.ptr[:-1], many)
    short = np.flatnonzero((count > 0) & (count < n))
    out = g[np.minimum(at, max(len(g) - 1, 0))] if len(g) else np.zeros(ptr[-1], np.uint64)
    for d in short:
        x = 0
        for h in words.hash[words.ptr[d] : words.ptr[d + 1]]:
            x = (x * int(BASE) + int(h)) & ((1 << 64) - 1)
        out[ptr[d]] = mix(np.array([x + 1], np.uint64))[0]
    return out, ptr


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

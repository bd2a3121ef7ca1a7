"""Suffix order with common-prefix lengths of a byte string, by induced sorting with bucket queues that spill to files.

Level 0 follows the induced sorting of L and S suffixes from the sorted left-most S suffixes. Each queue entry is a suffix with the
length of the common prefix that it has with the entry before it in its bucket: one more than the least such length that was
scanned between the two entries they come from. The left-most S suffixes are named by their substrings, and the reduced string
of names is sorted by doubling as deep as the common-prefix limit asks. Whole batches of a bucket move at once.
"""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs

#: Type of common-prefix lengths, and the longest one told apart.
LCP, LONGEST = np.uint16, 65_000


class Queue:
    """First-in first-out lists of (position, common prefix) by bucket; beyond `budget` bytes the fullest lists go to files."""

    def __init__(self, folder: str | None, budget: int):
        self.lists: list[list] = [[] for _ in range(256)]
        self.held = np.zeros(256, np.int64)
        self.files: dict[int, list[str]] = {}
        self.budget, self.folder, self.fs = budget, folder, None

    def put(self, bucket: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.lists[bucket].append((pos, lcp))
        self.held[bucket] += pos.nbytes + lcp.nbytes

    def relieve(self) -> None:
        while self.folder and self.held.sum() > self.budget:
            bucket = int(self.held.argmax())
            if self.fs is None:
                self.fs, self.root = pafs.FileSystem.from_uri(self.folder)
                self.root = f"{self.root}/queue-{uuid.uuid4().hex}"
                self.fs.create_dir(self.root, recursive=True)
            path = f"{self.root}/{bucket}-{len(self.files.get(bucket, []))}"
            pos, lcp = self._join(self.lists[bucket])
            with self.fs.open_output_stream(path) as f:
                f.write(pa.py_buffer(np.ascontiguousarray(pos)))
                f.write(pa.py_buffer(np.ascontiguousarray(lcp)))
            self.files.setdefault(bucket, []).append(path)
            self.lists[bucket], self.held[bucket] = [], 0

    @staticmethod
    def _join(chunks) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(0, LCP)
        return np.concatenate([c[0] for c in chunks]), np.concatenate([c[1] for c in chunks])

    def take(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        old = []
        for path in self.files.pop(bucket, []):
            with self.fs.open_input_stream(path) as f:
                raw = np.frombuffer(f.read(), np.uint8)
            m = len(raw) // (8 + np.dtype(LCP).itemsize)
            old.append((raw[: 8 * m].view(np.int64), raw[8 * m :].view(LCP)))
        out = self._join(old + self.lists[bucket])
        self.lists[bucket], self.held[bucket] = [], 0
        return out

    def close(self) -> None:
        if self.fs is not None:
            self.fs.delete_dir(self.root)


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo..hi]) for each pair, by a sparse table."""
    width = hi - lo + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    table, size = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            table = np.minimum(table[: len(table) - size], table[size:])
            size *= 2
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - size + 1])
    return out


class _Phase:
    def __init__(self, t: np.ndarray, cap: int, queue: Queue):
        self.t, self.cap, self.queue = t, cap, queue
        self.carry = np.full(256, cap, LCP)
        self.used = np.zeros(256, bool)

    def scan(self, pos: np.ndarray, lcp: np.ndarray, bucket: int, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Induces the predecessors for which wanted(symbol); returns those that stay in this bucket."""
        none = np.zeros(0, np.int64), np.zeros(0, LCP)
        if not len(pos):
            return none
        symbols = self.t[np.maximum(pos - 1, 0)]
        keep = np.flatnonzero(wanted(symbols) & (pos > 0))
        least = lcp.min()
        if not len(keep):
            np.minimum(self.carry, least, out=self.carry)
            return none
        a = symbols[keep]
        order = np.argsort(a, kind="stable")
        a, at = a[order], keep[order]
        first = np.concatenate(([True], a[1:] != a[:-1]))
        lo = np.concatenate(([0], at[:-1] + 1))
        lo[first] = 0
        low = _range_min(lcp, lo, at)
        heads = np.flatnonzero(first)
        low[heads] = np.minimum(low[heads], self.carry[a[heads]])
        new = np.minimum(low.astype(np.int64) + 1, self.cap).astype(LCP)
        new[heads[~self.used[a[heads]]]] = 0
        self.used[a[heads]] = True
        tails = np.append(heads[1:], len(a)) - 1
        last = at[tails]
        np.minimum(self.carry, least, out=self.carry)
        after = np.full(len(last), self.cap, LCP)
        open_end = np.flatnonzero(last + 1 < len(lcp))
        if len(open_end):
            after[open_end] = _range_min(lcp, last[open_end] + 1, np.full(len(open_end), len(lcp) - 1))
        self.carry[a[heads]] = after
        source = pos[at] - 1
        stay = none
        for c, s, e in zip(a[heads].tolist(), heads.tolist(), np.append(heads[1:], len(a)).tolist()):
            if c == bucket:
                stay = source[s:e], new[s:e]
            else:
                self.queue.put(c, source[s:e], new[s:e])
        return stay


def _run(t: np.ndarray, pos: int, cap: int) -> int:
    part = t[pos : pos + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _blocks(t: np.ndarray) -> np.ndarray:
    """Eight symbols from each position on as one integer."""
    out = np.zeros(len(t), np.uint64)
    for k in range(8):
        out <<= np.uint64(8)
        out[: max(0, len(t) - k)] |= t[k:]
    return out


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 0 of tuples, equal ones equal."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _leftmost(t: np.ndarray) -> np.ndarray:
    """Positions of the left-most S symbols, the last symbol included."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])
    nxt = change[np.minimum(np.searchsorted(change, np.arange(n)), max(len(change) - 1, 0))] if len(change) else np.zeros(n, np.int64)
    is_s = t[np.minimum(nxt + 1, n - 1)] > t if len(change) else np.zeros(n, bool)
    if len(change):
        is_s[change[-1] + 1 :] = False
    is_s[n - 1] = True
    out = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    return out if len(out) and out[-1] == n - 1 else np.append(out, n - 1)


def _names(t: np.ndarray, blocks: np.ndarray, lms: np.ndarray) -> np.ndarray:
    size = np.append(lms[1:] - lms[:-1] + 1, 1)

    def key(at: np.ndarray, r: int) -> np.ndarray:
        left = np.clip(size[at] - 8 * r, 0, 8)
        pad = np.where(left < 8, (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))), np.uint64(0))
        return blocks[np.minimum(lms[at] + 8 * r, len(t) - 1)] | pad

    names = _dense(key(np.arange(len(lms)), 0))
    r = 1
    while len(longer := np.flatnonzero(size > 8 * r)):
        among = np.flatnonzero(np.isin(names, names[longer]))
        rest = key(among, r)
        rest[size[among] <= 8 * r] = np.uint64(0xFFFFFFFFFFFFFFFF)
        sub = np.zeros(len(lms), np.int64)
        sub[among] = _dense(rest)
        names = _dense(names, sub)
        r += 1
    return names


def _order(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, `depth` names deep; ties in the order of positions."""
    rank, h = names, 1
    while h < depth and int(rank.max()) + 1 < len(rank):
        follow = np.zeros(len(rank), np.int64)
        follow[: len(rank) - h] = rank[h:] + 1
        rank = _dense(rank * (len(rank) + 2) + follow)
        h *= 2
    return np.argsort(rank, kind="stable")


def _common(blocks: np.ndarray, p: np.ndarray, q: np.ndarray, cap: int) -> np.ndarray:
    out, alive, r = np.zeros(len(p), np.int64), np.arange(len(p)), 0
    n = len(blocks)
    while len(alive) and r < cap:
        x, y = p[alive] + r, q[alive] + r
        d = blocks[np.minimum(x, n - 1)] ^ blocks[np.minimum(y, n - 1)]
        d[(x >= n) | (y >= n)] = np.uint64(1 << 63)
        equal = np.full(len(d), 8)
        for k in range(7, -1, -1):
            equal[d >> np.uint64(8 * (7 - k)) != 0] = k
        out[alive] += equal
        alive = alive[equal == 8]
        r += 8
    return np.minimum(out, cap)


def suffixes(t: np.ndarray, cap: int, folder: str | None = None, budget: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) for bytes t of 1..254 with a 0 at the end: suffixes in order, as far as `cap` symbols (at most LONGEST) decide, and the
    common prefix, capped, of each with the one before it."""
    if not 0 < cap <= LONGEST:
        raise ValueError(f"common prefixes are told apart up to {LONGEST} symbols")
    lms, blocks = _leftmost(t), _blocks(t)
    order = lms[_order(_names(t, blocks, lms), cap)]
    lcp = np.zeros(len(order), LCP)
    lcp[1:] = _common(blocks, order[:-1], order[1:], cap)
    del blocks
    heads = np.searchsorted(t[order], np.arange(257))
    small, large = Queue(folder, budget), Queue(folder, budget)
    none = np.zeros(0, np.int64), np.zeros(0, LCP)
    up = _Phase(t, cap, small)
    left: list = [none] * 256
    for c in range(256):
        rounds, batch = [], small.take(c)
        while len(batch[0]):
            rounds.append(batch)
            batch = up.scan(*batch, c, lambda a: a >= c)
        left[c] = Queue._join(rounds)
        s, e = heads[c], heads[c + 1]
        if e > s:
            own = lcp[s:e].copy()
            own[0] = min(_run(t, int(left[c][0][-1]), cap), _run(t, int(order[s]), cap)) if len(left[c][0]) else 0
            up.scan(order[s:e], own, c, lambda a: a > c)
        small.relieve()
    down = _Phase(t, cap, large)
    out, common = [], []
    for c in range(255, -1, -1):
        rounds, batch = [], large.take(c)
        if c == 0:
            batch = np.array([len(t) - 1]), np.zeros(1, LCP)
        while len(batch[0]):
            rounds.append(batch)
            batch = down.scan(*batch, c, lambda a: a <= c)
        pos, near = Queue._join(rounds)
        lpos, llcp = left[c]
        left[c] = none
        seam = min(_run(t, int(lpos[-1]), cap), _run(t, int(pos[-1]), cap)) if len(lpos) and len(pos) else 0
        if len(lpos):
            down.scan(lpos[::-1], np.concatenate(([seam], llcp[:0:-1])).astype(LCP), c, lambda a: a < c)
        out.append(np.concatenate((lpos, pos[::-1])))
        common.append(np.concatenate((llcp, np.concatenate((near[1:], [seam]))[::-1] if len(pos) else near)).astype(LCP))
        large.relieve()
    small.close()
    large.close()
    return np.concatenate(out[::-1]), np.concatenate(common[::-1])

"""Anchors: where documents that share a passage of `length` words or more are sure to meet.

The anchor of a window of `length` words is the k-word run in it with the least hash. Equal windows have equal anchors, so comparing
windows that have the same anchor hash finds every repeated window. Consecutive windows mostly have the same anchor; such a run of
windows is one row.
"""

import numpy as np

from sylvaspark.llm import textkit

LENGTH, K = 50, 8


class Runs:
    """Runs of windows of a batch: document, first window (word number in the document), number of windows, anchor hash."""

    def __init__(self, words: textkit.Words, length: int = LENGTH, k: int = K):
        empty = np.zeros(0, np.int64)
        self.doc = self.start = self.count = self.at = empty
        self.key = empty.astype(np.uint64)
        n = len(words.hash)
        if n < length:
            return
        kh = textkit.rolling_hash(words.hash, k)
        low = np.uint64(0xFFFFFFFF)
        v = (kh & ~low) | np.arange(len(kh), dtype=np.uint64)
        w, size = length - k + 1, 1
        while size * 2 <= w:
            v = np.minimum(v[: len(v) - size], v[size:])
            size *= 2
        v = np.minimum(v[: n - length + 1], v[w - size : w - size + n - length + 1])
        anchor = (v & low).astype(np.int64)
        many = np.maximum(words.count - length + 1, 0)
        first = words.ptr[:-1]
        at = np.arange(many.sum()) + np.repeat(first - np.concatenate(([0], np.cumsum(many)[:-1])), many)
        if not len(at):
            return
        doc, anchor = np.repeat(np.arange(len(many)), many), anchor[at]
        new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
        self.doc, self.at, self.key = doc[new], at[new], kh[anchor[new]]
        self.start = self.at - first[self.doc]
        self.count = np.diff(np.append(new, len(at)))


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + count[0] - 1, start[1], ..."""
    if not len(start):
        return np.zeros(0, np.int64)
    ptr = np.concatenate(([0], np.cumsum(count)))
    return np.arange(ptr[-1]) + np.repeat(start - ptr[:-1], count)

"""Winnowing over code points: rolling k-gram hashes and their window minima, for whole batches at once.

Of every window of ``w`` consecutive k-grams the least hash is kept, so two
texts that share ``k + w - 1`` characters share a kept k-gram inside the span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
#: Code points worked on at once; a longer text is a chunk of its own.
CHUNK = 400_000


def points(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``CHUNK`` characters each."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def kgram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k-gram at every position of ``codes`` where one fits, by doubling."""
    if len(codes) < k:
        return np.empty(0, np.uint64)
    cur = codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    cur ^= cur >> np.uint64(29)
    cur *= np.uint64(0x94D049BB133111EB)
    cur ^= cur >> np.uint64(32)
    n, got, size, done = len(codes), None, 1, 0
    while True:
        if k & 1:
            if got is None:
                got, done = cur, size
            else:
                m = n - done - size + 1
                got, done = got[:m] * _power(size) + cur[done : done + m], done + size
        k >>= 1
        if not k:
            break
        m = n - 2 * size + 1
        cur, size = cur[:m] * _power(size) + cur[size : size + m], 2 * size
    got = got ^ (got >> np.uint64(31))
    got *= np.uint64(0x94D049BB133111EB)
    got ^= got >> np.uint64(29)
    return got


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def kept(codes: np.ndarray, lengths: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowed k-grams of texts that lie one after another in ``codes``.

    Returns (hash as int64, index of the text, position in the text), in text
    order. Neither a k-gram nor a window crosses a border. Equal hashes of a
    window are all kept.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if len(codes) < k + w - 1:
        return none
    h = np.maximum(kgram_hashes(codes, k), np.uint64(1))
    ends = np.cumsum(lengths)
    starts = ends - lengths

    def inside(span: int) -> np.ndarray:
        """Whether ``span`` characters from a position on lie in one text."""
        mark = np.zeros(len(codes) + 1, np.int32)
        np.add.at(mark, np.maximum(starts, ends - span + 1), 1)
        np.add.at(mark, ends, -1)
        return np.cumsum(mark[:-1]) == 0

    fits = inside(k)[: len(h)]
    lows = _slide(h, w, np.minimum) if len(h) >= w else np.empty(0, np.uint64)
    lows[~inside(k + w - 1)[: len(lows)]] = 0
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero((_slide(np.concatenate([pad, lows, pad]), w, np.maximum) == h) & fits) if len(lows) else np.empty(0, np.int64)
    doc = np.searchsorted(ends, at, side="right")
    return h[at].view(np.int64), doc, at - starts[doc]

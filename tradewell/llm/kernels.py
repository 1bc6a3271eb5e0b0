"""Numpy kernels over the bytes of many texts at once (inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLANK, WORD, SIGN = 0, 1, 2


def byte_classes() -> np.ndarray:
    """Blank: space and 09-0D. Sign: the other ASCII characters that are
    neither letter nor digit. Word: the rest, with every non-ASCII byte."""
    c = np.full(256, WORD, np.uint8)
    c[:128] = SIGN
    for lo, hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
        c[lo:hi] = WORD
    c[[0x20, *range(0x09, 0x0E)]] = BLANK
    return c


def lower_bytes() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_chunks(col: pa.Array, budget: int = 1 << 20, most: int = 256):
    """(first row, end row, bytes, offsets) of runs of rows with about
    ``budget`` bytes and at most ``most`` rows. Null texts are empty; a long
    text is a run of its own."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("").cast(pa.large_string())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(off, off[lo] + budget, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + most, len(col))
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Hasher:
    """64-bit hashes of all words of a run of texts, without a loop over words."""

    def __init__(self):
        rnd = np.random.default_rng(20240607)
        self.table = rnd.integers(0, 1 << 64, 256, dtype=np.uint64)
        r = int(rnd.integers(0, 1 << 64, dtype=np.uint64)) | 5
        self.r, self.inv = r, pow(r, -1, 1 << 64)
        self.pows = self.invs = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.pows) <= n:
            m = 1 << int(n + 1).bit_length()

            def up(base):
                p = np.full(m, base & ((1 << 64) - 1), np.uint64)
                p[0] = 1
                return np.multiply.accumulate(p)
            self.pows, self.invs = up(self.r), up(self.inv)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.pows[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.invs[starts])


def word_spans(data: np.ndarray, off: np.ndarray, classes: np.ndarray, split_signs: bool = False):
    """Starts, ends and counts per text of the words; with ``split_signs`` runs
    of letters and runs of signs are units of their own."""
    kind = classes[data]
    if not split_signs:
        kind = (kind != BLANK).view(np.uint8)
    edge = np.ones(len(data) + 1, bool)
    if len(data) > 1:
        edge[1:-1] = kind[1:] != kind[:-1]
    edge[off] = True
    at = np.flatnonzero(edge)
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    starts, ends = at[:-1], at[1:]
    real = kind[starts] != BLANK
    starts, ends = starts[real], ends[real]
    return starts, ends, np.diff(np.searchsorted(starts, off))


def owner(counts: np.ndarray) -> np.ndarray:
    """Text number of each word."""
    return np.repeat(np.arange(len(counts)), counts)

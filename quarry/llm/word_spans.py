"""Words of whole texts as numpy spans into their UTF-8 bytes, and rolling
hashes over them.  All separators are ASCII, so bytes are enough."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK = bytes([9, 10, 11, 12, 13, 32])
#: Odd multipliers of the polynomial hashes, modulo 2**64.
LETTER_STEP, WINDOW_STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
CHUNK = 2 << 20


def flags(separators: bytes) -> np.ndarray:
    """True for every byte that is part of a word."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    out, k = np.ones(max(n, 1), np.uint64), 1
    while k < n:
        m = min(k, n - k)
        out[k:k + m] = out[:m] * np.uint64(pow(base, k, 2**64))
        k += m
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def letter_values() -> np.ndarray:
    """One pseudo-random 64-bit value per byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(LETTER_STEP))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column without nulls: text i is bytes[offsets[i]:offsets[i+1]]."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, byte after the last) of every word; no word crosses texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = offsets[:-1], offsets[1:]
    at = begin[begin < len(data)]
    first[at] = inside[at]
    at = end[(end > begin)] - 1
    last[at] = inside[at]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def cuts(data: np.ndarray, offsets: np.ndarray, word: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size``, never ending inside a word."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        limit = int(offsets[np.searchsorted(offsets, to)])
        while to < limit and word[data[to - 1]] and word[data[to]]:
            stop = np.flatnonzero(~word[data[to:min(to + 4096, limit)]])
            to = to + int(stop[0]) if len(stop) else min(to + 4096, limit)
        yield at, to
        at = to


class Hasher:
    """64-bit polynomial hashes of words, in chunks of bounded size."""

    def __init__(self, separators: bytes = BLANK, chunk: int = CHUNK):
        self.word, self.values, self.chunk = flags(separators), letter_values(), chunk
        self.up = self.down = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, self.chunk + 4096)
            self.up = powers(LETTER_STEP, size)
            self.down = powers(pow(LETTER_STEP, -1, 2**64), size)

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """(first byte, byte after the last, hash, text) of every word."""
        out = []
        for lo, hi in cuts(data, offsets, self.word, self.chunk):
            k, m = np.searchsorted(offsets, lo, "right") - 1, np.searchsorted(offsets, hi, "left")
            own = np.clip(offsets[k:m + 1], lo, hi) - lo
            s, e = spans(data[lo:hi], own, self.word)
            self._powers(hi - lo + 1)
            run = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(self.values[data[lo:hi]] * self.up[:hi - lo], out=run[1:])
            out.append((s + lo, e + lo, mixed((run[e] - run[s]) * self.down[s])))
        if not out:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        s, e, h = (np.concatenate(x) for x in zip(*out))
        return s, e, h, np.searchsorted(offsets, s, "right") - 1


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive words: each step drops the
    first word and takes the next one in (as prefix sums, modulo 2**64)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up = powers(WINDOW_STEP, len(words))
    run = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=run[1:])
    return (run[size:] - run[:n]) * powers(pow(WINDOW_STEP, -1, 2**64), n)

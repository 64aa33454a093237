"""Words of many texts at once: offsets and 64-bit hashes as numpy arrays over an Arrow string array.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which is the same as the
pattern `[^\\x20\\x09-\\x0D]+` on the characters of UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21
"""Bytes hashed together; longer single words are hashed in one block of their own."""

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of unsigned 64-bit values over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            made = []
            for b in self.base:
                steps = np.full(n, b)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
            self.up, self.down = made
        return self.up[:n], self.down[:n]


_POWERS = _Powers(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of a run of texts; `first[d]:first[d + 1]` are the words of text d."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def of(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word: a polynomial of its bytes, mixed with its length."""
        out = np.empty(len(self.starts), np.uint64)
        k = 0
        while k < len(out):
            base = self.starts[k]
            stop = max(k + 1, int(np.searchsorted(self.ends, base + BLOCK, "right")))
            a, b = self.starts[k:stop] - base, self.ends[k:stop] - base
            up, down = _POWERS.get(int(b[-1]) + 1)
            sums = np.zeros(int(b[-1]) + 1, np.uint64)
            np.cumsum((self.data[base : base + b[-1]].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
            out[k:stop] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
            k = stop
        return out


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; null reads as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array) -> Words:
    """Find the words of every text."""
    data, offsets = utf8(texts)
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    word = ~_SPACE[data]
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets, "left"))


def parts(column: pa.ChunkedArray | pa.Array, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts have about `size` bytes together, one row at least."""
    import pyarrow.compute as pc

    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(lengths)
    k = 0
    while k < len(lengths):
        base = ends[k] - lengths[k]
        stop = max(k + 1, int(np.searchsorted(ends, base + size, "right")))
        yield k, stop
        k = stop


def grams(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n consecutive words from each position; the last n - 1 positions are left out."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    rng = np.random.default_rng(7919 + seed)
    for j, c in enumerate(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)):
        out += hashes[j : j + count] * c
    return mix(out)

"""Words and word n-grams of UTF-8 texts, cut and hashed with numpy for a run of texts at once.

A word is a run of digits, a-z and characters beyond ASCII, after A-Z are
lower-cased. UTF-8 keeps all bytes of the latter above 0x7F, so bytes suffice.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
IN_WORD = np.zeros(256, bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True

_rng = np.random.default_rng(90210)
_SALT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_rng.integers(1 << 62, 1 << 63)) | 1
_STEP = np.uint64(int(_rng.integers(1 << 62, 1 << 63)) | 1)
_powers = {"n": 0}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chained(hashes: np.ndarray, bounds: np.ndarray, kind: int) -> np.ndarray:
    """A 64-bit hash of each text's word sequence; every ``kind`` is an independent one."""
    up, down = _grown(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes ^ np.uint64(kind * 0x1000193)) * up[: len(hashes)], out=sums[1:])
    n = np.diff(bounds).astype(np.uint64)
    return mixed((sums[bounds[1:]] - sums[bounds[:-1]]) * down[bounds[:-1]] + n)


@dataclass
class Words:
    """All words of a run of texts; text i has the words bounds[i] .. bounds[i + 1]."""

    data: np.ndarray  # lower-cased bytes of all texts
    first: np.ndarray
    last: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    def text(self, a: int, b: int) -> bytes:
        """Words a .. b, joined by single spaces."""
        return b" ".join(self.data[self.first[i] : self.last[i]].tobytes() for i in range(a, b))

    def owners(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of words i .. i + k for every i, whether they lie in one text)."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        h = self.hashes[:n].copy()
        for j in range(1, k):
            h = h * _STEP + self.hashes[j : j + n]
        own = self.owners()
        return mixed(h + np.uint64(k)), own[:n] == own[k - 1 :]

    def grams_at(self, at: np.ndarray, k: int) -> np.ndarray:
        """The hashes of ``grams`` at some places only."""
        h = self.hashes[at]
        for j in range(1, k):
            h = h * _STEP + self.hashes[at + j]
        return mixed(h + np.uint64(k))


def words_of(texts: pa.Array) -> Words:
    """The words of an Arrow array of strings without nulls."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = LOWER[data]
    inside = IN_WORD[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | border[1:-1]
    end[:-1] &= ~inside[1:] | border[1:-1]
    first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data] * up[: len(data)], out=sums[1:])
    hashes = mixed((sums[last] - sums[first]) * down[first])
    return Words(data, first, last, hashes, np.searchsorted(first, offsets))

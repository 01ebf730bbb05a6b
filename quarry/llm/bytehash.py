"""Hashes of words and byte ranges, computed with numpy over whole buffers.

A buffer's prefix sums of table[byte] * base**i (modulo 2**64) give the hash
of any range from two look-ups.  Tables come from fixed seeds, so hashes are
the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
#: bytes from which a word is hashed by itself
LONG_WORD = 128
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over the result (a 64-bit finaliser)."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1), or those of its inverse, modulo 2**64."""
    have = _POWERS.get((base, inverse))
    if have is None or len(have) < n:
        b = pow(base, -1, 1 << 64) if inverse else base
        p = np.full(max(n, 1 << 16), b, dtype=np.uint64)
        p[0] = 1
        have = np.multiply.accumulate(p)
        if len(have) <= 1 << 23:  # keep small tables only
            _POWERS[base, inverse] = have
    return have[:n]


class Ranges:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray, which: int = 0):
        self.base = BASES[which]
        self.n = len(buf)
        self.sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(table(which + 1)[buf] * powers(self.base, len(buf)), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * powers(self.base, self.n + 1, True)[start]
        return mix(raw + (end - start).astype(np.uint64) * _M2)


#: A-Z to a-z, and the other ASCII white space to a blank
LOWER = bytes(32 if c in b"\t\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_hashes(text: str, piece: int = 1 << 20) -> np.ndarray:
    """Hashes of the words (runs of anything but ASCII white space) of the
    A-Z-lower-cased text, in order.  Long texts are read in pieces that end
    at a blank."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    out = []
    at = 0
    while at < len(data):
        end = min(at + piece, len(data))
        if end < len(data):
            cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut
        out.append(_words(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _words(buf: np.ndarray) -> np.ndarray:
    solid = np.concatenate([[False], buf != 32, [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    out = Ranges(buf).hash(start, end)
    # polynomials modulo 2**64 can collide on long strings, whatever the base
    for i in np.flatnonzero(end - start >= LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buf[start[i]:end[i]].tobytes())
    return out


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; the whole sequence as
    one shingle if it is shorter; none without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    h = np.full(n - width + 1, width, dtype=np.uint64)
    for i in range(width):
        h = mix(h * _M1 + words[i:n - width + 1 + i])
    return np.unique(h)


def pieces(rows: list, size, most: int) -> Iterator[list]:
    """Consecutive rows in lists of at most ``most`` in total ``size`` (a
    larger row alone)."""
    held, total = [], 0
    for r in rows:
        s = size(r)
        if held and total + s > most:
            yield held
            held, total = [], 0
        held.append(r)
        total += s
    if held:
        yield held

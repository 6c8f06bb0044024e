"""Vectorised text scanning over Arrow buffers: no Python object is made for a word.

Words are runs of ASCII letters, digits, ``_`` and bytes of non-ASCII characters; each CJK or Hangul
character is a word of its own, as those scripts have no spaces.  A word's 64-bit hash is that of its
lower-case bytes: a polynomial in an odd base modulo 2**64, read off prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import offsets

BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(BASE, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True
_ALONE = np.zeros(256, bool)
_ALONE[0xE3:0xEE] = True
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    if len(_pow[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, _INV)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _pow[k] = np.cumprod(p, dtype=np.uint64)
    return _pow


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (xor-shift multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hash(word: str) -> int:
    """The hash of one word, in plain Python; the reference for ``words``."""
    h, p = 0, 1
    for b in word.lower().encode():
        h, p = (h + (b + 1) * p) & (2**64 - 1), p * BASE & (2**64 - 1)
    return int(mix(np.array([h], np.uint64))[0])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first word (one more at the end).

    A null text counts as empty.
    """
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    off = offsets(texts)
    n = int(off[-1] - off[0])
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    b = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    w = _WORD[b]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()  # the word ends with this byte
    last[:-1] &= ~w[1:]
    inner = off[(off > 0) & (off < n)]
    first[inner] = w[inner]
    last[inner - 1] = w[inner - 1]
    alone = np.flatnonzero(_ALONE[b])
    if len(alone):
        first[alone] = True
        last[alone[alone > 0] - 1] |= w[alone[alone > 0] - 1]
        after = alone + 3
        after = after[after < n]
        first[after] |= w[after]
        last[np.minimum(alone + 2, n - 1)] = True
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[e] - total[s]) * down[s]), np.searchsorted(s, off)


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``k`` words (of all its words if it has fewer), and where each text's begin."""
    n = np.diff(first)
    out = np.zeros(len(h), np.uint64)
    step = np.uint64(0xD6E8FEB86659FD93)
    m = max(0, len(h) - k + 1)
    for i in range(k):
        out[:m] = out[:m] * step + h[i : i + m]
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    for d in np.flatnonzero((n > 0) & (n < k)):
        x = 0
        for v in h[first[d] : first[d + 1]]:
            x = (x * int(step) + int(v)) & (2**64 - 1)
        out[first[d]] = x ^ int(n[d])
    start = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=start[1:])
    pick = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], count)
    return mix(out[pick]), start

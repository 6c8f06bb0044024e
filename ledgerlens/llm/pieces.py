"""Whole slices of texts to token ids without a Python object for most words.

The pattern's pieces are found by array operations on code points: runs of letters, digits or other characters,
each with a single space before it, contractions, and white space.  Pieces recur, so they are looked up by
hash in a table of pieces already encoded, and only new ones are given to the encoder.  Decoding
the result and comparing it with the text's bytes shows a false match of hashes; such a text is encoded piece by piece.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import offsets
from .textkernel import mix, powers

MOST_PIECES, MOST_IDS = 1_000_000, 8  # pieces a worker remembers, and ids for each of them on average; at most about 60 bytes each
_OTHER, _LETTER, _DIGIT, _SPACE = range(4)


@lru_cache
def kinds() -> np.ndarray:
    """Of each code point: letter, digit, white space or other, as the pattern's classes have it."""
    out = np.zeros(0x110000, np.uint8)
    points = np.delete(np.arange(0x110000, dtype=np.uint32), slice(0xD800, 0xE000))
    every = points.tobytes().decode("utf-32-le")
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[points[m.start()] : points[m.end() - 1] + 1] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin; ``codes`` are the code points of all, text i from first[i] to first[i + 1]."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[codes]
    edge = np.zeros(n + 4, bool)  # a text begins here; also beyond the end
    edge[first[first < n]] = True
    edge[n:] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    # a piece begins with each run, but for one that takes the space before it
    begin = run.copy()
    begin[1:] &= (codes[:-1] != 32) | edge[1:n] | (kind[1:] == _SPACE)
    # the last of some white space stands alone or goes to what follows
    last = kind == _SPACE
    last[:-1] &= run[1:] & ~edge[1:n]
    last[-1] = False
    begin |= last
    quote = np.flatnonzero((codes == 39) & begin)
    if len(quote):
        padded = np.append(codes, np.zeros(4, codes.dtype))
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "sdmt"]) & ~edge[quote + 1]
        two = (((a == 108) & (b == 108)) | (((a == 118) | (a == 114)) & (b == 101))) & ~edge[quote + 1] & ~edge[quote + 2]
        for at, size in ((quote[one], 1), (quote[two], 2)):
            begin[at + 1] = False
            after = at + 1 + size
            begin[after[after < n]] = True
    return np.flatnonzero(begin)


class PieceTable:
    """Encodes slices of texts with ``encode``, a function from a piece's bytes to its ids."""

    def __init__(self, encode, names: list[bytes], most: int = MOST_PIECES):
        self.encode_piece, self.most = encode, most
        self.size = np.array([len(b) for b in names], np.int64)
        self.at = np.append(0, np.cumsum(self.size))
        self.bytes = np.frombuffer(b"".join(names), np.uint8)
        self.clear()

    def clear(self) -> None:
        self.keys, self.rows = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)  # an open-addressing table; 0 is free
        self.begin, self.tokens, self.entries, self.used = np.zeros(1 << 12, np.int32), np.zeros(1 << 14, np.uint16 if len(self.size) <= 1 << 16 else np.int32), 0, 0
        self.again = np.zeros(1 << 12, bool)  # met since it was learnt, or since the last time that others were forgotten

    def _forget(self) -> None:
        """Keep only pieces met again, and none if these are many themselves."""
        k, r = self.keys[self.keys != 0], self.rows[self.keys != 0]
        k, r = k[self.again[r]], r[self.again[r]]
        n = self.begin[r + 1] - self.begin[r]
        if 2 * len(k) > self.most or 2 * n.sum() > MOST_IDS * self.most:
            return self.clear()
        end = np.cumsum(n)
        tokens = self.tokens[np.repeat(self.begin[r] - end + n, n) + np.arange(n.sum())]
        self.clear()
        self._enter(k, tokens, n)

    def _find(self, want: np.ndarray) -> np.ndarray:
        """The entry of each hash, -1 where there is none."""
        shift, mask = np.uint64(64 - (len(self.keys).bit_length() - 1)), len(self.keys) - 1
        slot = (want >> shift).view(np.int64)
        got = self.keys[slot]
        row = np.where(got == want, self.rows[slot], np.int32(-1))
        off = np.flatnonzero((got != want) & (got != 0))
        slot = slot[off]
        while len(off):
            slot = (slot + 1) & mask
            got = self.keys[slot]
            hit = got == want[off]
            row[off[hit]] = self.rows[slot[hit]]
            go = ~hit & (got != 0)
            off, slot = off[go], slot[go]
        return row

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        shift, mask = np.uint64(64 - (len(self.keys).bit_length() - 1)), len(self.keys) - 1
        slot = (keys >> shift).view(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]  # of several the last one wins
            won = self.keys[slot] == keys
            self.rows[slot[won]] = rows[won]
            keys, rows, slot = keys[~won], rows[~won], (slot[~won] + 1) & mask

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Enter new pieces, of distinct hashes; their entries."""
        got = list(map(self.encode_piece, pieces))
        return self._enter(keys, np.array([t for g in got for t in g], self.tokens.dtype), np.array([len(g) for g in got], np.int64))

    def _enter(self, keys: np.ndarray, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
        rows = np.arange(self.entries, self.entries + len(n), dtype=np.int32)
        while len(self.begin) < self.entries + len(n) + 1:
            self.begin, self.again = np.append(self.begin, np.zeros_like(self.begin)), np.append(self.again, np.zeros_like(self.again))
        while len(self.tokens) < self.used + len(tokens):
            self.tokens = np.append(self.tokens, np.zeros_like(self.tokens))
        self.begin[self.entries + 1 : self.entries + len(n) + 1] = self.used + np.cumsum(n)
        self.tokens[self.used : self.used + len(tokens)] = tokens
        self.entries, self.used = self.entries + len(n), self.used + len(tokens)
        if 2 * self.entries > len(self.keys):
            old = self.keys != 0
            k, r = self.keys[old], self.rows[old]
            size = len(self.keys)
            while size < 2 * self.entries:
                size *= 2
            self.keys, self.rows = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._place(k, r)
        self._place(keys, rows)
        return rows

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, count of each text, whether decoding gives each text back); a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        off = offsets(texts)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
        off = off - off[0]
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64), np.ones(len(texts), bool)
        text = raw.tobytes().decode("utf-8", "surrogatepass")
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lead = np.append(0, np.cumsum((raw & 0xC0) != 0x80)) if len(codes) < len(raw) else None
        first = off if lead is None else lead[off]
        s = starts(codes, first)
        e = np.append(s[1:], len(codes))
        up, down = powers(len(codes))
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
        h = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        h[h == 0] = 1
        if self.entries > self.most or self.used > MOST_IDS * self.most:
            self._forget()
        row = self._find(h)
        self.again[row[row >= 0]] = True
        lost = np.flatnonzero(row < 0)
        if len(lost):
            u, one, back = np.unique(h[lost], return_index=True, return_inverse=True)
            i = lost[one]
            row[lost] = self._learn(u, [text[a:b].encode("utf-8", "surrogatepass") for a, b in zip(s[i].tolist(), e[i].tolist())])[back]
        begin, n = self.begin[row].astype(np.int64), self.begin[row + 1] - self.begin[row]
        end = np.cumsum(n)
        ids = self.tokens[np.repeat(begin - end + n, n) + np.arange(end[-1])].astype(np.int32)
        piece = np.searchsorted(s, first)  # the first piece of each text
        count = np.diff(np.append(0, end)[piece])
        same = self._same(ids, count, raw, off)
        if not same.all():  # a false match of hashes
            parts, at = [], np.append(0, np.cumsum(count))
            for k in range(len(texts)):
                if same[k]:
                    parts.append(ids[at[k] : at[k + 1]])
                else:
                    i = slice(piece[k], piece[k + 1])
                    parts.append(np.array([t for a, b in zip(s[i].tolist(), e[i].tolist()) for t in self.encode_piece(text[a:b].encode("utf-8", "surrogatepass"))], np.int32))
            ids, count = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
            same = self._same(ids, count, raw, off)
        return ids, count, same

    def _same(self, ids: np.ndarray, count: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Whether the ids of each text decode to its bytes."""
        size = self.size[ids]
        end = np.cumsum(size)
        at = np.append(0, np.cumsum(count))
        held = np.diff(np.append(0, end)[at])
        if (held != np.diff(off)).any():
            return np.array([held[k] == off[k + 1] - off[k] and self._decoded(ids[at[k] : at[k + 1]]) == raw[off[k] : off[k + 1]].tobytes() for k in range(len(count))], bool)
        got = self.bytes[np.repeat(self.at[ids] - end + size, size) + np.arange(len(raw))]
        wrong = np.flatnonzero(got != raw)
        out = np.ones(len(count), bool)
        out[np.searchsorted(off, wrong, "right") - 1] = False
        return out

    def _decoded(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes[a : a + n].tobytes() for a, n in zip(self.at[ids].tolist(), self.size[ids].tolist()))

"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can come last in the prefix's encoding: the one that ends
there, begins where some shorter prefix ends, and forms a valid pair with that prefix's last token.  Storing that
token for each prefix gives the encoding by walking back; appending bytes extends the table, and after an edit
only entries near it are computed anew, up to where the old ones apply again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids, slices
from .pieces import PieceTable

PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHED = 200_000  # pairs a worker remembers
SLICE = 1 << 18  # bytes of text encoded at once; the arrays for it take about 100 times as many


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """A vocabulary whose ids are merge ranks, single bytes first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes[i] = b
        self.longest = max(map(len, ranks))
        self.known: dict[tuple[int, int], bool] = {}
        self._matcher = None
        self.left, self.right = list(range(len(self.bytes))), list(range(len(self.bytes)))
        self.pairs: dict[tuple[int, int], int] = {}
        for b, i in sorted(ranks.items(), key=lambda x: x[1]):  # each token's last merge, by the smaller ones
            if len(b) > 1:
                for cut in range(1, len(b)):
                    x, y = ranks.get(b[:cut]), ranks.get(b[cut:])
                    if x is not None and y is not None and x < i and y < i and self.valid(x, y, i):
                        self.left[i], self.right[i], self.pairs[x, y] = x, y, i
                        break

    def valid(self, x: int, y: int, below: int = 1 << 30) -> bool:
        """Whether x then y stay two tokens when their joined bytes are encoded with merges below a rank.

        The merges that made x and y are undone, latest first, on the two sides of the seam; any merge across
        the seam that would have come earlier than those still standing shows the pair to be impossible.
        """
        left, right, pairs = self.left, self.right, self.pairs
        while True:
            seam = pairs.get((x, y))
            if seam is not None and seam < below:
                return False
            if x > y:
                below, x = x, right[x]
                if x == below:
                    below = y + 1
                    y = left[y]
                    if y + 1 == below:
                        return True
            else:
                below = y + 1
                y = left[y]
                if y + 1 == below:
                    below, x = x, right[x]
                    if x == below:
                        return True

    def extend(self, data: bytes, last: list[int], stop: int | None = None, same: list[int] | None = None, shift: int = 0, clean: int = 0) -> None:
        """Append to ``last`` the last tokens of the prefixes of ``data`` beyond those that it already covers.

        With ``same``, entries of the string before an edit: from position ``clean`` on, after as many equal entries
        as the longest token has bytes, the rest is taken from there, ``shift`` positions before.
        """
        get, valid, names = self.ranks.get, self.valid, self.bytes
        n, equal = len(data) if stop is None else stop, 0
        for i in range(len(last) + 1, n + 1):
            for j in range(max(0, i - self.longest), i):  # longest first
                t = get(data[j:i])
                if t is not None and (not j or valid(last[j - 1], t)):
                    last.append(t)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if same is not None and i > clean:
                equal = equal + 1 if same[i - 1 - shift] == last[-1] else 0
                if equal >= self.longest:
                    last += same[i - shift :]
                    return

    def walk(self, last: list[int]) -> list[int]:
        out, i = [], len(last)
        while i:
            out.append(last[i - 1])
            i -= len(self.bytes[last[i - 1]])
        out.reverse()
        return out

    def matcher(self):
        """An Aho-Corasick automaton that lists, for each end position, the tokens that end there."""
        if self._matcher is None:
            self._matcher = ahocorasick.Automaton()
            for b, i in self.ranks.items():
                self._matcher.add_word(b.decode("latin-1"), (i, len(b)))
            self._matcher.make_automaton()
        return self._matcher

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_matcher": None, "known": {}}

    def encode_piece(self, data: bytes) -> list[int]:
        """The tokens of one piece of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        known, valid, last, done = self.known, self.valid, [], -1
        for end, (t, n) in self.matcher().iter(data.decode("latin-1")):
            if end == done:
                continue
            j = end - n
            if j >= 0:
                pair = (last[j], t)
                ok = known.get(pair)
                if ok is None:
                    if len(known) >= CACHED:
                        known.clear()
                    ok = known[pair] = valid(*pair)
                if not ok:
                    continue
            last.append(t)
            done = end
        if len(last) < len(data):
            raise ValueError("the vocabulary lacks a byte")
        return self.walk(last)

    def decode(self, tokens) -> bytes:
        return b"".join(map(self.bytes.__getitem__, tokens))


class Text:
    """A text that is kept encoded under appends and edits; always equal to encoding it anew."""

    def __init__(self, encoder: Encoder, text: str = "", pattern: str = PATTERN):
        self.encoder, self.split = encoder, regex.compile(pattern)
        self.text, self.pieces = "", []  # pieces: [end in text, bytes, last tokens]
        self.edit(0, 0, text)

    def append(self, text: str) -> None:
        self.edit(len(self.text), len(self.text), text)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace text[start:end].

        Pieces that end before the edit and the white space next to it stay (a piece depends on its own text, the
        white space after it and one more character).  From there on the text is split again until a piece begins
        where one began before, beyond the edit.
        """
        clean = len(self.text[:start].rstrip())
        shift = len(new) - (end - start)
        old, self.text = self.pieces, self.text[:start] + new + self.text[end:]
        keep = 0
        while keep < len(old) and old[keep][0] < clean:
            keep += 1
        begins = {p[0] + shift: k + 1 for k, p in enumerate(old) if p[0] >= end}
        at, fresh, rest = (old[keep - 1][0] if keep else 0), [], len(old)
        before = old[keep] if keep < len(old) else None
        for m in self.split.finditer(self.text, at):
            data = m[0].encode()
            last: list[int] = []
            if before and m.start() == at:  # the first piece shares its beginning with what stood there
                n = next((i for i, (a, b) in enumerate(zip(data, before[1])) if a != b), min(len(data), len(before[1])))
                last = before[2][:n]
            self.encoder.extend(data, last)
            fresh.append([m.end(), data, last])
            if m.end() >= start + len(new) and m.end() in begins:
                rest = begins[m.end()]
                break
        self.pieces = old[:keep] + fresh + [[e + shift, d, t] for e, d, t in old[rest:]]

    def tokens(self) -> list[int]:
        return list(chain.from_iterable(self.encoder.walk(p[2]) for p in self.pieces))


_tables: dict[str, PieceTable] = {}


def piece_table(path: str, shared=None) -> PieceTable:
    """This process's table of encoded pieces for a vocabulary; from a broadcast encoder if given."""
    if path not in _tables:
        encoder = shared.value if shared is not None else Encoder(read_ranks(path))
        _tables[path] = PieceTable(encoder.encode_piece, encoder.bytes)
    return _tables[path]


def _encode(path: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path, shared)
        for b in slices(batches, most=SLICE):
            flat, n, exact = table.encode(b.column(1))
            null = b.column(1).is_null().to_numpy(zero_copy_only=False)
            tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(flat, pa.int32()), mask=pa.array(null))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, mask=null), tokens, pa.array(exact, mask=null)], ["doc_id", "n_tokens", "tokens", "exact"])
    return run


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, tokens, exact) for each row; exact tells that decoding gave the text's bytes back.

    An empty text has no tokens; a null text has null results.  Repeated rows are encoded each; rows without an
    id are left out; other columns are never read.  ``vocabulary`` is read on the driver and broadcast (the size
    of a vocabulary doesn't grow with the data).
    """
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("doc_id"), text)
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(read_ranks(vocabulary)))
    return d.mapInArrow(_encode(vocabulary, shared), "doc_id long, n_tokens long, tokens array<int>, exact boolean")


def decode(rows: DataFrame, key: str = "doc_id", tokens: str = "tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text): the texts that token lists stand for; null lists give null texts, empty ones empty texts.

    Repeated rows are decoded each; rows without an id are left out; an empty table gives an empty one.
    """
    d = ids(rows, key, tokens).select(F.col(key).cast("long").alias("doc_id"), tokens)
    ranks = read_ranks(vocabulary)
    names = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        names[i] = b
    shared = rows.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.__getitem__
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if t is None else b"".join(map(get, t)).decode("utf-8", "replace") for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])
    return d.mapInArrow(run, "doc_id long, text string")

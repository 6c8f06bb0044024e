"""Token ids as compressed binary blocks: an adaptive context-mixing range coder.

Within a block three models predict the next id.  Order 2 and order 1 recall the id that last followed the last two
ids and the last one; order 0 is the distribution of the ids so far over a uniform floor, renewed at fixed positions.
Their distributions are blended, each with its own weight, into one from which a 64-bit range coder codes the id.
The weights adapt: they follow how often each model has been right in the same situation, told by how long either
recalled prediction has been right and whether the two agree.  Every block starts afresh and carries a checksum, so
blocks are coded side by side here, and read in any order.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import VOCABULARY, Encoder, piece_table, read_ranks
from .common import ids, slices

BLOCK, ALPHABET, GAIN, MOST = 8192, 1 << 16, 32, 3  # tokens a block; ids below; weight of a count; longest streak told apart
REFRESH, SHARE = 512, 255  # positions between renewals of order 0; largest weight of a model, less 1
BATCH, GROUP = 1 << 23, 32  # tokens coded at once; blocks modelled at once, as fit the cache
TOP, BOTTOM = 1 << 48, 1 << 32  # 16 bits leave at a time
_STREAKS = MOST + 2  # 0: nothing recalled; else 1 + streak


@lru_cache
def refreshes(n: int) -> tuple[int, ...]:
    """Positions from which on order 0 knows all ids before them."""
    out = [0, 64, 128, 256, REFRESH]
    while out[-1] < n:
        out.append(out[-1] + REFRESH)
    return tuple(out)


def _recalled(x: np.ndarray, context: np.ndarray, pos: np.ndarray, bits: int, first: np.ndarray, above: int) -> tuple[np.ndarray, np.ndarray]:
    """(prediction, streak): the id that followed the last occurrence of each position's context, and 1 + how many
    predictions in a row were right in that context (at most MOST); streak 0 where the context is new.

    A context's number has its block's in the bits from ``above`` on; positions count within blocks.
    """
    key = np.sort((context << bits) | pos)
    context = key >> bits
    at = first[context >> above] + (key & ((1 << bits) - 1))
    same = np.zeros(len(x), bool)
    same[1:] = context[1:] == context[:-1]
    got = x[at]
    hit = np.zeros(len(x), bool)
    hit[1:] = same[1:] & (got[1:] == got[:-1])
    i = np.arange(len(x), dtype=np.int32)
    run = i - np.maximum.accumulate(np.where(hit, 0, i))  # hits in a row up to here
    out, conf = np.zeros_like(x), np.zeros_like(x)
    out[at[1:]] = got[:-1]
    conf[at[1:]] = np.where(same[1:], 1 + np.minimum(run[:-1], MOST), 0)
    return out, conf


def _before(x: np.ndarray, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smaller, equal, known): of the ids that order 0 knows at each position, how many are smaller, equal, and all."""
    smaller, equal, known = (np.zeros(len(x), np.int32) for _ in range(3))
    for a, n in zip(first.tolist(), size.tolist()):
        if not n:
            continue
        marks = np.array([m for m in refreshes(n) if m < n], np.int64)
        key = np.sort((x[a : a + n].astype(np.int64) << 32) | np.arange(n))
        pos = key & 0xFFFFFFFF
        new = (key >> 32)[1:] != (key >> 32)[:-1]
        code = np.zeros(n, np.int32)
        code[pos[1:]] = np.cumsum(new)
        distinct = int(new.sum()) + 1
        part = np.repeat(np.arange(len(marks), dtype=np.int32), np.diff(np.append(marks, n)))  # since which mark
        held = np.bincount(part * distinct + code, minlength=len(marks) * distinct).astype(np.int32).reshape(-1, distinct)
        upto = np.zeros((len(marks), distinct + 1), np.int32)  # by mark: ids before it that are smaller than each
        np.cumsum(held[:-1], 0, out=upto[1:, 1:])
        np.cumsum(upto[:, 1:], 1, out=upto[:, 1:])
        at = part * (distinct + 1) + code
        flat = upto.ravel()
        smaller[a : a + n] = flat[at]
        equal[a : a + n] = flat[at + 1] - flat[at]
        known[a : a + n] = marks[part]
    return smaller, equal, known


def _intervals(x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cumulative, frequency, total) of each id of blocks of ``size`` ids under the blended model."""
    x, n, first = x.astype(np.int32), len(x), np.cumsum(size) - size
    block = np.repeat(np.arange(len(size), dtype=np.int32), size)
    pos = np.arange(n, dtype=np.int32) - np.repeat(first.astype(np.int32), size)
    bits = int(size.max() if len(size) else 0).bit_length()
    one, two = np.full(n, ALPHABET, np.int64), np.full(n, ALPHABET, np.int64)
    one[1:], two[2:] = x[:-1], x[:-2]
    one[pos == 0], two[pos <= 1] = ALPHABET, ALPHABET
    one |= block.astype(np.int64) << 17
    p1, s1 = _recalled(x, one, pos, bits, first, 17)
    p2, s2 = _recalled(x, (one << 17) | two, pos, bits, first, 34)
    del one, two
    agree = (s1 > 0) & (s2 > 0) & (p1 == p2)
    situation = (s2 * _STREAKS + s1) * 2 + agree
    can2, can1 = s2 > 0, (s1 > 0) & ~agree
    right = np.where(can2 & (x == p2), np.int8(0), np.where(can1 & (x == p1), np.int8(1), np.int8(2)))
    group = block * (2 * _STREAKS * _STREAKS) + situation
    order = np.argsort(group.astype(np.uint16) if len(size) <= 1300 else group, kind="stable")  # 16 bits: radix sort
    group = group[order]
    begin = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]) if n else np.zeros(0, bool), np.arange(n, dtype=np.int32), 0))
    seen = np.arange(1, n + 1, dtype=np.int32) - begin  # 1 + how often the situation was met
    weight = np.empty((3, n), np.int32)
    taken = right[order]
    for k in range(3):
        mine = taken == k
        before = np.cumsum(mine, dtype=np.int32) - mine
        weight[k, order] = 1 + SHARE * (before - before[begin]) // seen
    w2, w1, w0 = weight
    w2[~can2], w1[~can1] = 0, 0
    smaller, equal, known = _before(x, size, first)
    mass = ALPHABET + GAIN * known
    w2 *= mass
    w1 *= mass
    cum = w0 * (x + GAIN * smaller) + np.where(p2 < x, w2, 0) + np.where(p1 < x, w1, 0)
    freq = w0 * (1 + GAIN * equal) + np.where(p2 == x, w2, 0) + np.where(p1 == x, w1, 0)
    return cum.astype(np.uint32), freq.astype(np.uint32), (w0 * mass + w2 + w1).astype(np.uint32)


def encode_blocks(x: np.ndarray, size: np.ndarray) -> list[bytes]:
    """The payload of each block; ``x`` holds the blocks' ids one after another."""
    lanes, longest = np.argsort(-size, kind="stable"), int(size.max() if len(size) else 0)
    if not longest:
        return [b""] * len(size)
    cut = np.append(0, np.cumsum(size))
    code = np.ones((3, longest, len(size)), np.uint32)  # by position, then by lane
    lane_of = np.empty(len(size), np.int64)
    lane_of[lanes] = np.arange(len(size))
    for i in range(0, len(size), GROUP):
        parts = _intervals(x[cut[i] : cut[min(i + GROUP, len(size))]], size[i : i + GROUP])
        own = cut[i : i + GROUP] - cut[i]
        same = bool((size[i : i + GROUP] == longest).all())
        for k in range(3):
            if same:
                code[k][:, lane_of[i : i + GROUP]] = parts[k].reshape(-1, longest).T
            else:
                for b, (a, n) in enumerate(zip(own.tolist(), size[i : i + GROUP].tolist())):
                    code[k, :n, lane_of[i + b]] = parts[k][a : a + n]
    low, wide = np.zeros(len(lanes), np.uint64), np.full(len(lanes), 0xFFFFFFFFFFFFFFFF, np.uint64)
    out, used = np.zeros((len(lanes), longest * 3 // 2 + 64), np.uint16), np.zeros(len(lanes), np.int64)
    top, bottom, step, high = np.uint64(TOP), np.uint64(BOTTOM), np.uint64(16), np.uint64(48)
    ends = np.searchsorted(-size[lanes], -np.arange(1, longest + 1), "right")
    for e, live in enumerate(ends.tolist()):
        c, f, t = code[:, e, :live].astype(np.uint64)
        r = wide[:live] // t
        c *= r
        c += low[:live]
        f *= r
        lo, r = c, f
        due = np.flatnonzero((lo ^ (lo + r)) < top)
        tight = np.flatnonzero(r < bottom)
        while len(due) or len(tight):
            if len(tight):  # what straddles a boundary is cut short
                tight = tight[(lo[tight] ^ (lo[tight] + r[tight])) >= top]
                r[tight] = (~lo[tight] + np.uint64(1)) & (bottom - np.uint64(1))
                due = np.append(due, tight)
            at = used[due]
            if at.max() >= out.shape[1]:
                out = np.concatenate([out, np.zeros_like(out)], 1)
            now, range_ = lo[due], r[due]
            out[due, at] = now >> high
            used[due] = at + 1
            now <<= step
            range_ <<= step
            lo[due], r[due] = now, range_
            small = range_ < bottom
            settled = (now ^ (now + range_)) < top
            due, tight = due[settled], due[small & ~settled]
        low[:live], wide[:live] = lo, r
    out = np.concatenate([out, np.zeros((len(lanes), 4), np.uint16)], 1)
    for k in range(4):
        out[np.arange(len(lanes)), used + k] = (low >> np.uint64(48 - 16 * k)) & np.uint64(0xFFFF)
    out = out.astype(">u2")
    payload: list[bytes] = [b""] * len(lanes)
    for i, lane in enumerate(lanes.tolist()):
        payload[lane] = out[i, : used[i] + 4].tobytes() if size[lane] else b""
    return payload


def checksum(x: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(x, "<u4").tobytes())


def decode_block(payload: bytes, n: int, crc: int | None = None) -> np.ndarray:
    """The ids of one block; raises ValueError if they don't have the checksum."""
    mask = (1 << 64) - 1
    low, wide, code, at = 0, mask, int.from_bytes(payload[:8].ljust(8, b"\0"), "big"), 8
    x: list[int] = []
    memory: tuple[dict, dict] = ({}, {})  # context -> [last id, streak]
    counts: dict[int, list[int]] = {}
    prefix: list[int] = []
    marks = set(refreshes(n))
    for i in range(n):
        if i in marks:
            prefix = sorted(x)
        one = x[-1] if i else ALPHABET
        keys = (one, (one, x[-2] if i > 1 else ALPHABET))
        (p1, s1), (p2, s2) = ((m[k][0], 1 + min(m[k][1], MOST)) if k in m else (0, 0) for m, k in zip(memory, keys))
        agree = s1 > 0 and s2 > 0 and p1 == p2
        seen = counts.setdefault((s2 * _STREAKS + s1) * 2 + agree, [0, 0, 0])
        w2, w1, w0 = (1 + SHARE * c // (1 + sum(seen)) for c in seen)
        mass = ALPHABET + GAIN * len(prefix)
        w2, w1 = w2 * mass if s2 else 0, w1 * mass if s1 and not agree else 0

        def below(t: int) -> int:
            return w0 * (t + GAIN * bisect_left(prefix, t)) + (w2 if p2 < t else 0) + (w1 if p1 < t else 0)  # noqa: B023

        total = w0 * mass + w2 + w1
        r = wide // total
        v = min(((code - low) & mask) // r, total - 1)
        a, b = 0, ALPHABET - 1  # the last id whose interval begins at or before v
        while a < b:
            m = (a + b + 1) // 2
            a, b = (m, b) if below(m) <= v else (a, m - 1)
        t, c = a, below(a)
        low, wide = (low + c * r) & mask, (below(a + 1) - c) * r
        while True:
            if (low ^ ((low + wide) & mask)) >= TOP:
                if wide >= BOTTOM:
                    break
                wide = -low & (BOTTOM - 1)
            code = ((code << 16) | int.from_bytes(payload[at : at + 2].ljust(2, b"\0"), "big")) & mask
            at += 2
            low, wide = (low << 16) & mask, (wide << 16) & mask
        seen[0 if s2 and t == p2 else 1 if s1 and not agree and t == p1 else 2] += 1
        for m, k in zip(memory, keys):
            m[k] = [t, m[k][1] + 1 if m[k][0] == t else 0] if k in m else [t, 0]
        x.append(t)
    got = np.array(x, np.int64)
    if crc is not None and checksum(got) != crc:
        raise ValueError("a block doesn't have its checksum")
    return got


def _write(path: str, shared, block: int):
    """Blocks of exactly ``block`` ids, but for the last of a batch: texts go on from one to the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path, shared)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # texts' ids, their counts and their tokens
        n = 0

        def out() -> pa.RecordBatch:
            doc, length, x = (np.concatenate(c) for c in zip(*held))
            size = np.full(-(-len(x) // block), block, np.int64)
            size[-1] -= size.sum() - len(x)
            end = np.cumsum(length)
            payload, rows = encode_blocks(x, size), []
            for k, p in enumerate(payload):
                a = k * block
                b = a + int(size[k])
                i, j = int(np.searchsorted(end, a, "right")), int(np.searchsorted(end, b, "left")) + 1
                begin = np.maximum(a, end[i:j] - length[i:j])
                rows.append((doc[i:j].tolist(), (begin - end[i:j] + length[i:j]).tolist(), (np.minimum(b, end[i:j]) - begin).tolist(), b - a, checksum(x[a:b]), p))
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_ids", "starts", "lengths", "n_tokens", "crc32", "payload"])

        for b in slices(batches):
            x, count, _ = table.encode(b.column(1))
            some = count > 0
            if some.any():
                held.append((b.column(0).to_numpy()[some], count[some], x))
                n += len(x)
            if n >= BATCH:
                yield out()
                held, n = [], 0
        if n:
            yield out()
    return run


def write(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """(doc_ids, starts, lengths, n_tokens, crc32, payload): one row a block of ``block`` token ids.

    The i-th part of a block is of document doc_ids[i], its tokens from starts[i] on, lengths[i] of them; a long
    document goes on in the next block.  Null and empty texts have no tokens and aren't in any block; repeated
    rows are written each; rows without an id are left out; other columns are never read.  Nothing is shuffled.
    """
    ranks = read_ranks(vocabulary)
    if max(ranks.values()) >= ALPHABET:
        raise ValueError(f"ids must be below {ALPHABET}")
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("doc_id"), text)
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(ranks))
    return d.mapInArrow(_write(vocabulary, shared, block), "doc_ids array<long>, starts array<long>, lengths array<long>, n_tokens int, crc32 long, payload binary")


def read(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, tokens): the parts of documents that blocks hold, each block checked.

    A repeated block gives its parts again; no blocks give no rows.  A damaged block is an error, others read alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = decode_block(r["payload"], r["n_tokens"], r["crc32"])
                cut = np.cumsum([0, *r["lengths"]])
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(r["starts"], pa.int64()), pa.array([x[i:j].tolist() for i, j in zip(cut, cut[1:])], pa.list_(pa.int32()))], ["doc_id", "start", "tokens"])
    return blocks.mapInArrow(run, "doc_id long, start long, tokens array<int>")

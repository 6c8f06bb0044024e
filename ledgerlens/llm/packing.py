"""Related-document packing.

Texts are compared by fingerprints: of every ``SPAN`` consecutive runs of ``gram`` words the one of the smallest hash
(winnowing), so that any two texts with ``gram`` + ``SPAN`` - 1 = 8 words in a row in common share one.  Two texts'
cosine is that of their sets of fingerprints, and each text's ``k`` nearest others are its neighbours.  Along greedy
paths over this graph, begun at texts of low degree, related texts come one after another, and windows of ``window``
tokens are cut from each path.

The neighbours are exact, whatever the number of a fingerprint's holders.  Up to ``REACH`` + 1 holders meet two by two.
Of the other fingerprints, the long ones, those of the same holders count as one of a weight, and texts with the same
long ones form a class.  How many long ones two texts share depends on their classes alone, so of a class only the
k + 1 smallest texts can be the nearest of one with which they share nothing else: classes are compared with all
classes, in tiles, and each text takes the k + 1 nearest of its class.  Pairs that share a short fingerprint as well
get the count of the long ones from their classes, unless k others are nearer even if all the long ones were shared.

Holder lists are cut at texts whose id's hash says so, the same for all lists; thus lists of the same texts meet piece
by piece in one place, where their pairs are counted before they travel.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_BYTES, ids, slices, stored
from .graph import components
from .textkernel import mix, shingles, words

GRAM, SPAN, K, WINDOW, PART_WINDOWS = 7, 2, 8, 2048, 4096
REACH, CUT = 32, 128  # holders of a short list but one; one text of so many begins a new piece of a list
BUCKET, BATCH, OFTEN = 500_000, 500_000, 32  # fingerprints of a task and of a row of it; count in a batch from which one is reported
HOT = 200_000  # holders from which on a fingerprint's list is dealt to several tasks
LONG_ROW, KEYS = 65_536, 4_000_000  # holders in a row of a long list; pairs held before they are counted
ASKED, TILES, MOST_ASKED, OTHERS = 20_000, 6, 4_000_000, 4_000_000  # long fingerprints of a block of classes that asks, such blocks while they hold at most so many, and those of a block that is asked
PIECE = 1_000_000  # texts of a component from which on its links are walked from disk
STEPS = (0.1, 0.2, 0.4, 0.8)  # cosines below which a larger component is cut
_ROWS, _BITS = 4096, 12  # texts fingerprinted at once; a fingerprint has the other 52 bits
_GRAM = (1 << (64 - _BITS)) - 1


def fingerprints(texts: pa.Array, gram: int = GRAM, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, fingerprint, words of each text); fingerprints are distinct within a text and sorted."""
    h, first = words(texts)
    x, start = shingles(h, first, gram)
    n = np.diff(start)
    tokens = np.diff(first)
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), tokens
    low, have = x.copy(), 1
    while have < span:  # low[i] is the smallest of x[i : i + have]
        step = min(have, span - have)
        n_low = max(0, len(x) - step)
        low[:n_low] = np.minimum(low[:n_low], low[step:])
        have += step
    text = np.repeat(np.arange(len(n)), n)
    whole = np.arange(len(x)) + span <= start[text + 1]  # windows within a text
    few = np.flatnonzero((n > 0) & (n < span))  # one window, the whole of it
    if len(few):
        whole[start[few]] = True
        for d in few.tolist():
            low[start[d]] = x[start[d] : start[d + 1]].min()
    key = ((low[whole] >> np.uint64(_BITS)) << np.uint64(_BITS)) | text[whole].astype(np.uint64)
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    key = np.sort(key[fresh])
    key = key[np.append(True, key[1:] != key[:-1])]
    return (key & np.uint64(_ROWS - 1)).astype(np.int64), (key >> np.uint64(_BITS)).astype(np.int64), tokens


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        for i in range(0, b.num_rows, _ROWS):
            yield b.slice(i, _ROWS)


def _survey(gram: int, span: int, often: int):
    """Each text's words and fingerprints, and, without an id, fingerprints that many texts of one batch have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def rows(ids_, tokens, size, x, count):
            return pa.RecordBatch.from_arrays([pa.concat_arrays([ids_, pa.nulls(len(x), pa.int64())]), pa.array(np.append(tokens, np.zeros(len(x), np.int64))),
                                               pa.array(np.append(size, count)), pa.concat_arrays([pa.nulls(len(tokens), pa.int64()), pa.array(x, pa.int64())])], ["id", "tokens", "size", "fingerprint"])

        def common() -> pa.RecordBatch:
            x, count = np.unique(np.concatenate(held), return_counts=True)
            x, count = x[count >= often], count[count >= often]
            return rows(pa.nulls(0, pa.int64()), np.zeros(0, np.int64), np.zeros(0, np.int64), x, count)

        for b in _slices(batches):
            text, x, tokens = fingerprints(b.column(1), gram, span)
            held.append(x)
            n += len(x)
            yield rows(b.column(0), tokens, np.bincount(text, minlength=b.num_rows), x[:0], x[:0])
            if n >= 4 * BATCH:
                yield common()
                held, n = [], 0
        if n:
            yield common()
    return run


def _with_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(words(b.column(1))[1])), b.column(1)], ["id", "tokens", "text"])


def _place(doc: np.ndarray) -> np.ndarray:
    """The order of all texts, and what else is drawn by id."""
    return mix(doc.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _deal(x: np.ndarray, place: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Fingerprints with, in the upper bits, which part of the order a hot one's holder lies in."""
    name, parts = hot
    if not len(name):
        return x
    at = np.minimum(np.searchsorted(name, x), len(name) - 1)
    part = np.where(name[at] == x, ((place >> np.uint64(40)).astype(np.int64) * parts[at]) >> 24, 0)
    return x | (part << (64 - _BITS))


def _pack(a: np.ndarray) -> bytes:
    """Fixed-width values as bytes, the first byte of each, then the second and so on, as compresses well."""
    return a.view(np.uint8).reshape(len(a), -1).T.tobytes()


def _flat(table: pa.Table, name: str, kind: type) -> np.ndarray:
    """The values of a packed column, all rows' one after another."""
    width = np.dtype(kind).itemsize
    got = [np.frombuffer(x, np.uint8).reshape(width, -1).T for x in table[name].to_pylist()]
    return np.ascontiguousarray(np.concatenate(got)).view(kind).ravel()


def _steps(a: np.ndarray) -> np.ndarray:
    """Ascending ids as the first and the differences, as packs smaller."""
    return np.append(a[:1], np.diff(a))


def _ids(table: pa.Table, name: str) -> np.ndarray:
    """The ids of a packed column that holds each row's ``_steps``."""
    return np.concatenate([np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.int64).ravel()) for x in table[name].to_pylist()])


def _rows(target: np.ndarray, columns: dict[str, tuple[np.ndarray, np.ndarray]], steps: tuple[str, ...] = ()) -> pa.RecordBatch:
    """One row for each value of the sorted ``target``; of each column (values, where each row's begin and the last ends)."""
    cells = [pa.array([_pack(_steps(v[i:j]) if name in steps else v[i:j]) for i, j in zip(c.tolist(), c[1:].tolist())], pa.binary()) for name, (v, c) in columns.items()]
    return pa.RecordBatch.from_arrays([pa.array(target, pa.int64()), *cells], ["target", *columns])


def _owned(target: np.ndarray, owner: np.ndarray, owned: dict[str, np.ndarray], inner: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row a target: of runs of equal ``owner`` the ``owned`` values and the lengths, and the ``inner`` values of all.

    Of the ids, which ascend within a target, the row has the ``_steps``.

    The arrays are sorted by target, then owner.
    """
    at = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (target[1:] != target[:-1])))
    row = np.flatnonzero(np.append(True, target[at][1:] != target[at][:-1]))
    by_run, by_value = np.append(row, len(at)), np.append(at[row], len(target))
    runs = {name: v[at] for name, v in owned.items()} | {"counts": np.diff(np.append(at, len(target))).astype(np.int32)}
    return _rows(target[at[row]], {n: (v, by_run) for n, v in runs.items()} | {n: (v, by_value) for n, v in inner.items()}, ("ids",))


_HELD = "target long, ids binary, sizes binary, counts binary, grams binary"


def _holders(gram: int, span: int, targets: int, hot):
    """For each batch and target one row: texts, how many fingerprints each has in all and here, and these.

    A fingerprint's target is its remainder by the number of targets, and the row has the quotient alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def out() -> pa.RecordBatch:
            doc, size, x = (np.concatenate(c) for c in zip(*held))
            if (doc[1:] < doc[:-1]).any():
                order = np.argsort(doc, kind="stable")
                doc, size, x = doc[order], size[order], x[order]
            x, target = np.divmod(_deal(x, _place(doc), hot.value).view(np.uint64), np.uint64(targets))
            target = target.astype(np.int64)
            order = np.argsort(target.astype(np.uint16) if targets < 1 << 16 else target, kind="stable")
            doc, size, x, target = doc[order], size[order], x[order], target[order]
            return _owned(target, doc, {"ids": doc, "sizes": size.astype(np.int32)}, {"grams": x})

        for b in _slices(batches):
            text, x, _ = fingerprints(b.column(1), gram, span)
            if not len(x):
                continue
            order = np.argsort(text.astype(np.uint16), kind="stable")
            text, x = text[order], x[order]
            held.append((b.column(0).to_numpy()[text], np.bincount(text, minlength=b.num_rows)[text], x))
            if (n := n + len(x)) >= BATCH:
                yield out()
                held, n = [], 0
        if n:
            yield out()
    return run


_LISTS = "target long, mains binary, counts binary, ids binary, sizes binary, gram long, sig long"


def _lists(reach: int, cut: int, targets: int, hot):
    """Of one target's fingerprints the holder lists: short ones in pieces, holders and the next ones; long ones whole.

    A long list is that of more than ``reach`` + 1 holders or any part of a hot fingerprint's.  Its rows have no
    target but the fingerprint and the sum without carry of its holders' hashes.
    """
    def run(table: pa.Table) -> pa.Table:
        doc, size = _ids(table, "ids"), _flat(table, "sizes", np.int32)
        x = (_flat(table, "grams", np.uint64) * np.uint64(targets) + np.uint64(table["target"][0].as_py())).view(np.int64)
        own = np.repeat(np.arange(len(doc)), _flat(table, "counts", np.int32))
        order = np.argsort(_place(doc), kind="stable")
        doc, size = doc[order], size[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        order = np.argsort(x)
        x = x[order]
        equal = x[1:] == x[:-1]
        shared = np.append(equal, False) | np.append(False, equal)
        if len(hot.value[0]):
            shared |= np.isin(x & _GRAM, hot.value[0])  # of one part's only holder the partners are in others
        x, own = x[shared], rank[own[order[shared]]]
        if not len(x):
            return _none(_LISTS)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        name = x[first] & _GRAM
        gram = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        own = np.sort((gram << 32) | own) & 0xFFFFFFFF
        n = np.diff(np.append(first, len(gram)))
        long = (n > reach + 1) | np.isin(name, hot.value[0])
        out = []
        for g in np.flatnonzero(long).tolist():
            for i in range(first[g], first[g] + n[g], LONG_ROW):
                held = own[i : min(i + LONG_ROW, first[g] + n[g])]
                sig = np.bitwise_xor.reduce(mix(_place(doc[held]))).view(np.int64)
                out.append([None, b"", b"", _pack(doc[held]), _pack(size[held]), int(name[g]), int(sig)])
        begins = _place(doc[own]) % np.uint64(cut) == 0
        begins[first] = True
        a = np.flatnonzero(begins)  # a piece begins
        b = np.append(a[1:], len(gram))
        g = gram[a]
        c = np.minimum(b + reach, (first + n)[g])
        some = (c - a > 1) & ~long[g]
        a, b, c = a[some], b[some], c[some]
        kinds = [pa.int64(), *[pa.binary()] * 4, pa.int64(), pa.int64()]
        rest = pa.table([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 7, kinds)], _names(_LISTS))
        if not len(a):
            return rest
        target = (mix(doc[own[a]].view(np.uint64)) % np.uint64(targets)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        a, b, c, target = a[order], b[order], c[order], target[order]
        length = c - a
        end = np.cumsum(length)
        take = np.arange(end[-1]) - np.repeat(end - length, length) + np.repeat(a, length)
        row = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        by_piece, by_text = np.append(row, len(a)), np.append(0, end)[np.append(row, len(a))]
        small = {"mains": b - a, "counts": length}
        short = pa.Table.from_batches([_rows(target[row], {n: (v.astype(np.int32), by_piece) for n, v in small.items()} | {"ids": (doc[own[take]], by_text), "sizes": (size[own[take]], by_text)})])
        for c in ("gram", "sig"):
            short = short.append_column(c, pa.nulls(short.num_rows, pa.int64()))
        return pa.concat_tables([short, rest])
    return run


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _none(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.table([pa.array([], kinds[c.split()[1]]) for c in schema.split(", ")], _names(schema))


_MET = "target long, ids binary, sizes binary, counts binary, nears binary, near_sizes binary, shared binary"


def _meet(targets: int):
    """How many fingerprints the texts of pieces of short lists share two by two, each pair from both sides."""
    def run(table: pa.Table) -> pa.Table:
        mains, count = (_flat(table, c, np.int32).astype(np.int64) for c in ("mains", "counts"))
        doc, at, code = np.unique(_flat(table, "ids", np.int64), return_index=True, return_inverse=True)
        size = _flat(table, "sizes", np.int32)[at]
        piece = np.repeat(np.arange(len(count)), count)
        begin = np.cumsum(count) - count
        inner = np.arange(len(piece)) - begin[piece]
        left = count[piece] - inner  # holders from here on
        i, u, d = np.flatnonzero(inner < mains[piece]), len(doc), 0
        key, shared, keys, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        while len(i):
            d += 1
            i = i[left[i] > d]
            for at in range(0, len(i), KEYS):
                p, q = code[i[at : at + KEYS]], code[i[at : at + KEYS] + d]
                keys.append(np.minimum(p, q) * u + np.maximum(p, q))
                held += len(p)
                if held >= KEYS:
                    key, shared = _added(key, shared, *_counted(np.concatenate(keys)))
                    keys, held = [], 0
        if keys:
            key, shared = _added(key, shared, *_counted(np.concatenate(keys)))
        if not len(key):
            return _none(_MET)
        p, q, shared = np.append(key // u, key % u), np.append(key % u, key // u), np.append(shared, shared)
        target = (mix(doc.view(np.uint64)) % np.uint64(targets)).astype(np.int64)[p]
        order = np.lexsort((p, target))
        p, q, shared, target = p[order], q[order], shared[order], target[order]
        return pa.Table.from_batches([_owned(target, p, {"ids": doc[p], "sizes": size[p]}, {"nears": doc[q], "near_sizes": size[q], "shared": shared.astype(np.int32)})])
    return run


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[at], np.diff(np.append(at, len(key)))


def _added(key: np.ndarray, n: np.ndarray, more: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return more, m
    key, n = np.append(key, more), np.append(n, m)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[at], np.add.reduceat(n[order], at)


def _nearest(k: int):
    """Of the texts of one target, by short lists, the k nearest of each; of those in a class all that might be nearest."""
    def run(table: pa.Table, placed: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _none(_FOUND)
        count = _flat(table, "counts", np.int32)
        doc, n = np.repeat(_ids(table, "ids"), count), np.repeat(_flat(table, "sizes", np.int32), count).astype(np.int64)
        near, m, shared = _flat(table, "nears", np.int64), _flat(table, "near_sizes", np.int32).astype(np.int64), _flat(table, "shared", np.int32)
        order = np.lexsort((near, doc))
        doc, n, near, m, shared = doc[order], n[order], near[order], m[order], shared[order]
        at = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (near[1:] != near[:-1])))
        shared = np.add.reduceat(shared, at).astype(np.int64)
        doc, n, near, m = doc[at], n[at], near[at], m[at]
        least = shared.astype(np.float64) ** 2 / m
        order = np.lexsort((near, -least, doc))
        doc, n, near, m, shared, least = doc[order], n[order], near[order], m[order], shared[order], least[order]
        first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        many = np.diff(np.append(first, len(doc)))
        best = np.arange(len(doc)) - np.repeat(first, many) < k
        kind = np.zeros(len(doc), np.int64)
        classed = np.zeros(len(doc), bool)
        if placed.num_rows:
            placed = placed.sort_by("id")
            name = placed["id"].to_numpy()
            j = np.minimum(np.searchsorted(name, doc), len(name) - 1)
            classed = name[j] == doc
            kind = placed["class"].to_numpy()[j]
            kth = np.where(many >= k, least[np.minimum(first + k, len(doc)) - 1], 0)
            most = (shared + np.minimum(placed["weight"].to_numpy()[j], m - shared)).astype(np.float64) ** 2 / m
            best |= classed & (most >= np.repeat(kth, many) * (1 - 1e-9))
        return pa.table([doc[best], near[best], n[best], m[best], shared[best], pa.array(kind[best], mask=~classed[best])], _names(_FOUND))
    return run


_FOUND = "id long, near long, size long, near_size long, shared long, class long"
_TILE = "class long, near long, near_size long, shared long"


def _each(targets: int):
    """A row for each holder of long lists (fingerprint, weight, ids, sizes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                t = pa.Table.from_batches([b.slice(i, 1)])
                doc, size = _flat(t, "ids", np.int64), _flat(t, "sizes", np.int32).astype(np.int64)
                target = (mix(doc.view(np.uint64)) % np.uint64(targets)).astype(np.int64)
                gram, weight = (np.full(len(doc), t[c][0].as_py(), np.int32) for c in ("gram", "weight"))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (target, doc, size, gram, weight)], ["target", "id", "size", "gram", "weight"])
    return run


def _tile(k: int):
    """For each class that asks (role 0) the k + 1 nearest texts of the classes asked (role 1), by long fingerprints.

    Nearest is by the square of the number shared over the size, ties by id: the asking text's own size is the same
    for all.
    """
    def run(table: pa.Table) -> pa.Table:
        role = table["role"].to_numpy()
        asked, other = (table.filter(pa.array(role == r)).combine_chunks() for r in (0, 1))
        if not asked.num_rows or not other.num_rows:
            return _none(_TILE)
        flat = lambda t, c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ends = lambda t, c: np.append(0, np.cumsum(pc.list_value_length(t[c]).to_numpy()))
        least = flat(other, "sizes")[ends(other, "sizes")[:-1]]  # of each class the smallest text's
        order = np.argsort(least, kind="stable")
        other, least = other.take(pa.array(order)).combine_chunks(), least[order].astype(np.float64)
        of, held, at = other.num_rows, ends(other, "grams"), flat(other, "grams")
        order = np.argsort(at, kind="stable")
        owner = np.repeat(np.arange(of), np.diff(held))[order]
        at, weight = at[order], flat(other, "weights")[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        gram, weigh = at[first], weight[first]
        place = np.repeat(np.arange(len(gram)), np.diff(np.append(first, len(at)))) * of + owner
        text, doc, size = ends(other, "ids"), flat(other, "ids"), flat(other, "sizes")
        ask, name = ends(asked, "grams"), flat(asked, "grams")
        j = np.minimum(np.searchsorted(gram, name), len(gram) - 1)
        there = gram[j] == name
        out = []
        for a in range(asked.num_rows):
            g = j[ask[a] : ask[a + 1]][there[ask[a] : ask[a + 1]]]
            if not len(g):
                continue
            hit, n, done, step, end = np.zeros(0, np.int64), np.zeros(0), 0, 1024, of
            all_ = float(weigh[g].sum())
            while done < end:  # by size, until even one that had all of the fingerprints would be further
                upto = min(done + step, end)
                x, y = np.searchsorted(place, g * of + done), np.searchsorted(place, g * of + upto)
                many = y - x
                i = np.repeat(x - np.cumsum(many) + many, many) + np.arange(many.sum())
                more = np.bincount(owner[i] - done, weight[i], upto - done)
                new = np.flatnonzero(more)
                hit, n = np.append(hit, new + done), np.append(n, more[new])
                if len(hit) > k:
                    best = n**2 / least[hit]
                    kth = np.partition(best, -k - 1)[-k - 1]
                    hit, n = hit[best >= kth], n[best >= kth]
                    end = min(of, int(np.searchsorted(least, all_**2 / kth * (1 + 1e-9), "right")))
                done, step = upto, step * 4
            many = text[hit + 1] - text[hit]
            e = np.repeat(text[hit] - np.cumsum(many) + many, many) + np.arange(many.sum())
            n = np.repeat(n, many)
            e, n = (v[np.lexsort((doc[e], -(n**2) / size[e]))[: k + 1]] for v in (e, n))
            out.append((np.full(len(e), a), doc[e], size[e], n.astype(np.int64)))
        if not out:
            return _none(_TILE)
        a, doc, size, n = (np.concatenate(c) for c in zip(*out))
        return pa.table([asked["class"].to_numpy()[a], doc, size, n], _names(_TILE))
    return run


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows with a number each from 0 on, without gaps and in their order."""
    drawn = stored(rows.withColumn("m", F.monotonically_increasing_id()))
    sizes = drawn.groupBy(F.shiftright("m", 33).alias("task")).agg(F.count("*").alias("n"))
    before = sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    got = drawn.join(F.broadcast(before), F.shiftright("m", 33) == F.col("task"))
    return stored(got.withColumn(name, F.col("m").bitwiseAND((1 << 33) - 1) + F.col("before")).drop("m", "task", "before"))


def _classes(long: DataFrame, k: int, targets: int) -> tuple[DataFrame, DataFrame]:
    """Of long lists' rows: (target, id, class, weight, size) of each holder, and of each class its fingerprints and k + 1 smallest texts."""
    whole = long.groupBy("gram").agg(F.expr("bit_xor(sig)").alias("sig"), F.sum(F.octet_length("ids")).alias("n"))
    names = whole.where("n > 8").groupBy("sig", "n").agg(F.min("gram").alias("gram"), F.count("*").cast("int").alias("weight"))
    names = _numbered(names.select("gram", "weight"), "number").withColumn("number", F.col("number").cast("int"))  # half as wide as fingerprints on all ways from here
    each = long.select("gram", "ids", "sizes").join(names, "gram").select(F.col("number").alias("gram"), "weight", "ids", "sizes").mapInArrow(_each(targets), "target long, id long, size long, gram int, weight int")
    held = each.groupBy("id").agg(F.first("target").alias("target"), F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("gram", "weight"))).alias("held"), F.sum("weight").alias("weight"))
    held = stored(held.select("target", "id", "size", F.xxhash64("held").alias("class"), "weight", "held"))
    first = held.withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("size", "id"))).where(F.col("r") <= k + 1)
    kinds = first.groupBy("class").agg(F.first("held").alias("held"), F.array_sort(F.collect_list(F.struct("size", "id"))).alias("texts"))
    kinds = kinds.select("class", F.col("held.gram").alias("grams"), F.col("held.weight").alias("weights"), F.col("texts.id").alias("ids"), F.col("texts.size").alias("sizes"))
    return held.select("target", "id", "size", "class", "weight"), stored(kinds)


def _nearest_of_classes(kinds: DataFrame, k: int, asked: int | None = None, others: int = OTHERS) -> DataFrame:
    """(class, near, near_size, shared): the k + 1 nearest texts by long fingerprints, a text of the class itself included.

    All classes are compared with all that share one, a block that asks with one that is asked in each task.
    """
    total = kinds.agg(F.sum(F.size("grams"))).first()[0] or 0
    rows = -(-total // asked) if asked else max(min(TILES, -(-total // ASKED)), -(-total // MOST_ASKED))
    rows, columns = max(1, rows), max(1, -(-total // others))
    of = lambda n, other, name, all_: [F.pmod("class", F.lit(n)).alias(name), F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(all_)]
    none = F.array().cast("array<long>")
    ask = kinds.select(F.lit(0).alias("role"), "class", "grams", F.array().cast("array<int>").alias("weights"), none.alias("ids"), none.alias("sizes"), *of(rows, columns, "a", "b"))
    reply = kinds.select(F.lit(1).alias("role"), "class", "grams", "weights", "ids", "sizes", *of(columns, rows, "b", "a"))
    best = ask.unionByName(reply).groupBy("a", "b").applyInArrow(_tile(k), _TILE)
    by = Window.partitionBy("class").orderBy(F.desc(_square()), "near")
    return stored(best.withColumn("r", F.row_number().over(by)).where(F.col("r") <= k + 1).drop("r"))


def _square():
    return F.col("shared").cast("double") * F.col("shared") / F.col("near_size")


def _common(kinds: DataFrame, pairs: DataFrame) -> DataFrame:
    """(class, near_class, long): by how much the long fingerprints of two classes weigh that both have."""
    grams, weights = kinds.select("class", "grams", "weights"), kinds.select(F.col("class").alias("near_class"), F.col("grams").alias("theirs"))
    both = pairs.join(grams, "class").join(weights, "near_class")
    return both.select("class", "near_class", "grams", "weights", "theirs").mapInArrow(_shared, "class long, near_class long, long long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        row = np.concatenate([np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(c)).to_numpy()) for c in (2, 4)])
        mine, weight, theirs = (b.column(c).flatten().to_numpy() for c in (2, 3, 4))
        x, weight = np.append(mine, theirs), np.append(weight, np.zeros(len(theirs), np.int64))
        order = np.lexsort((x, row))
        x, row, weight = x[order], row[order], weight[order]
        both = np.flatnonzero((x[1:] == x[:-1]) & (row[1:] == row[:-1]))
        n = np.bincount(row[both], weight[both] + weight[both + 1], b.num_rows).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n)], ["class", "near_class", "long"])


def neighbours(d: DataFrame, total: int, hot: tuple[np.ndarray, np.ndarray] | None = None, k: int = K, gram: int = GRAM, span: int = SPAN, reach: int = REACH, cut: int = CUT, bucket: int = BUCKET, asked: int | None = None, others: int = OTHERS) -> DataFrame:
    """(id, near, cos): the ``k`` nearest others of each text (id, text), ties by id; those of cosine 0 are none.

    ``total`` is about how many fingerprints all texts have, ``hot`` names those of very many holders and among how
    many tasks each is dealt.  Ids are distinct.
    """
    targets = -(-total // bucket) | 1  # odd, so that parts of one hot fingerprint, whole multiples of 2**52 apart, go to different ones
    shared = d.sparkSession.sparkContext.broadcast(hot or (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    held = d.mapInArrow(_holders(gram, span, targets, shared), _HELD)
    lists = stored(held.groupBy("target").applyInArrow(_lists(reach, cut, targets, shared), _LISTS))
    placed, kinds = _classes(lists.where("gram is not null"), k, targets)
    short = lists.where("target is not null").select("target", "mains", "counts", "ids", "sizes")
    met = short.groupBy("target").applyInArrow(_meet(targets), _MET)
    found = stored(met.groupBy("target").cogroup(placed.groupBy("target")).applyInArrow(_nearest(k), _FOUND))
    cos = F.rint(F.col("shared") / F.sqrt(F.col("size").cast("double") * F.col("near_size")) * 1e12) / 1e12
    done = found.where("class is null").select("id", "near", cos.alias("cos"))
    if kinds.isEmpty():
        return done
    rest = found.where("class is not null").join(placed.select(F.col("id").alias("near"), F.col("class").alias("near_class")), "near", "left")
    common = _common(kinds, stored(rest.where("near_class is not null").select("class", "near_class").distinct()))
    columns = ["id", "near", "size", "near_size", "shared"]
    rest = rest.join(common, ["class", "near_class"], "left").withColumn("shared", F.col("shared") + F.coalesce("long", F.lit(0)))
    wide = placed.join(_nearest_of_classes(kinds, k, asked, others), "class").where("id <> near")
    every = rest.select(columns).unionByName(wide.select(columns)).repartition("id")
    every = every.groupBy("id", "near").agg(F.first("size").alias("size"), F.first("near_size").alias("near_size"), F.max("shared").alias("shared"))
    best = every.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc(_square()), "near"))).where(F.col("r") <= k)
    return done.unionByName(best.select("id", "near", cos.alias("cos")))


def hottest(every: DataFrame, hot: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints reported of at least ``hot`` texts, sorted, and how many tasks each one's holders are dealt to.

    Their number is at most the texts' fingerprints over ``hot``; where even that wouldn't fit the workers, ``hot``
    is raised until it does, and the tasks of those below it get longer lists.
    """
    count = stored(every.where("id is null").groupBy("fingerprint").agg(F.sum("size").alias("n")).where(F.col("n") >= hot))
    while count.where(F.col("n") >= hot).count() * 16 > MAX_BROADCAST_BYTES // 4:
        hot *= 2
    got = count.where(F.col("n") >= hot).orderBy("fingerprint").toArrow()
    return got["fingerprint"].to_numpy(), np.minimum((1 << _BITS) - 1, -(-got["n"].to_numpy() // hot))


def walk(near: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(order, path): texts in the order visited and the number of each one's path.

    Each path begins at the unvisited text of the lowest degree (ties: the first) and goes on to the unvisited
    neighbour of the highest cosine (ties: the first) until there is none.  The graph has an edge wherever either
    end has the other among its neighbours.
    """
    n = len(near)
    links: list[dict[int, float]] = [{} for _ in range(n)]
    for d, (e, c) in enumerate(near):
        for x, y in zip(e.tolist(), c.tolist()):
            links[d][x] = links[x][d] = y
    ranked = [sorted(x, key=lambda e: (-x[e], e)) for x in links]
    seen, order, path, number = bytearray(n), [], [], 0
    for s in sorted(range(n), key=lambda d: (len(links[d]), d)):
        if seen[s]:
            continue
        at: int | None = s
        while at is not None:
            seen[at] = 1
            order.append(at), path.append(number)
            at = next((e for e in ranked[at] if not seen[e]), None)
        number += 1
    return np.array(order, np.int64), np.array(path, np.int64)


def _walk_component(table: pa.Table) -> pa.Table:
    table = table.sort_by([("id", "ascending"), ("cos", "descending"), ("near", "ascending")])
    doc = np.unique(table["id"].to_numpy())
    name = table["component"][0].as_py()
    table = table.filter(table["near"].is_valid())
    cut = np.searchsorted(table["id"].to_numpy(), np.append(doc, doc[-1] + 1))
    near, cos = np.searchsorted(doc, table["near"].to_numpy()), table["cos"].to_numpy()
    order, path = walk([(near[i:j], cos[i:j]) for i, j in zip(cut, cut[1:])])
    return pa.table({"id": doc[order], "component": np.full(len(doc), name), "path": path, "step": np.arange(len(doc))})


def pieces(near: DataFrame, most: int = PIECE) -> DataFrame:
    """(id, component): components in pieces, of (id, near, cos); texts that share no link are never in one.

    ``pack`` doesn't cut them: see ``walks``.

    Connected components of at most ``most`` texts are kept whole.  Larger ones are cut where their links are
    weakest, by one step of ``STEPS`` after the other, and what is still too large then, texts all much alike, by
    ranges of the order of all texts, in which alike texts' neighbours are close.
    """
    links, done = near.select(F.col("id").alias("src"), F.col("near").alias("dst"), "cos"), None
    for step in (*STEPS, None):
        group = stored(components(links.select("src", "dst")))
        size = group.groupBy("component").count()
        large = stored(size.where(F.col("count") > most))
        done = _and(done, group.join(large.select("component"), "component", "left_anti").select("id", "component"))
        if large.isEmpty():
            return done
        over = group.join(large, "component")
        if step is None:
            part = F.floor(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) * F.ceil(F.col("count") / most) / F.lit(1 << 30))
            return _and(done, over.select("id", F.xxhash64("component", part).alias("component")))
        links = stored(links.where(F.col("cos") >= step).join(over.select(F.col("id").alias("src")), "src", "left_semi"))
        alone = over.select("id").join(links.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "id", "left_anti")
        done = _and(done, alone.select("id", F.col("id").alias("component")))


def _and(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return stored(b if a is None else a.unionByName(b))


def paths(near: DataFrame, most: int = PIECE) -> DataFrame:
    """(id, component, path, step) for all texts that have a neighbour, of (id, near, cos).

    Each of ``pieces`` is walked by one task, which gets its links, never texts.
    """
    near = stored(near)
    group = pieces(near, most)
    ends = near.join(group, "id").join(group.select(F.col("id").alias("near"), F.col("component").alias("other")), "near")
    ends = ends.withColumn("near", F.when(F.col("component") == F.col("other"), F.col("near")))  # a text all whose links were cut stays
    return ends.select("component", "id", "near", "cos").groupBy("component").applyInArrow(_walk_component, "id long, component long, path long, step long")


def _walk_spilled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of ``walk`` through whole components, whose links (component, src, dst) come in the order they are tried.

    Texts are numbered in the order in which paths may begin.  Links wait in a file of the task's own, as Spark's
    spills do; in memory are nine bytes a text.
    """
    name, held = None, None
    for b in batches:
        component, src, dst = (b.column(c).to_numpy() for c in range(3))
        cut = np.flatnonzero(component[1:] != component[:-1]) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(component)]):
            if i == j:
                continue
            if held is None or component[i] != name:
                if held is not None:
                    yield from held.walk(name)
                name, held = component[i], _Links(src[i])
            held.add(src[i:j], dst[i:j])
    if held is not None:
        yield from held.walk(name)


class _Links:
    """Lists of numbered texts' neighbours in a file, written in the order of the texts."""

    def __init__(self, first: int):
        self.first, self.last, self.n = first, None, 0
        self.begins: list[np.ndarray] = []
        self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)

    def add(self, src: np.ndarray, dst: np.ndarray) -> None:
        new = np.append(src[0] != self.last, src[1:] != src[:-1])
        self.begins.append(np.flatnonzero(new) + self.n)
        self.n, self.last = self.n + len(src), src[-1]
        self.file.write((dst - self.first).astype(np.uint32).tobytes())

    def _near(self, begin: int, end: int, step: int = 4096) -> Iterator[int]:
        for i in range(begin, end, step):
            yield from np.frombuffer(os.pread(self.file.fileno(), 4 * (min(end, i + step) - i), 4 * i), np.uint32).tolist()

    def walk(self, name: int, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        self.file.flush()
        begins = np.concatenate([*self.begins, [self.n]])
        self.begins = []
        seen, order, path, number, done = bytearray(len(begins) - 1), [], [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(order), name)), pa.array(np.array(order, np.int64) + self.first), pa.array(path, pa.int64()), pa.array(np.arange(done, done + len(order)))], ["component", "at", "path", "step"])

        start = 0
        while (start := seen.find(0, start)) >= 0:
            at: int | None = start
            while at is not None:
                seen[at] = 1
                order.append(at), path.append(number)
                if len(order) == rows:
                    yield out()
                    done, order, path = done + rows, [], []
                at = next((e for e in self._near(int(begins[at]), int(begins[at + 1])) if not seen[e]), None)
            number += 1
        if order:
            yield out()
        self.file.close()


def _large_walks(links: DataFrame) -> DataFrame:
    """(id, component, path, step) of components too large for one task's memory, of their (component, id, near, cos)."""
    both = links.unionByName(links.select("component", F.col("near").alias("id"), F.col("id").alias("near"), "cos"))
    both = stored(both.groupBy("component", "id", "near").agg(F.max("cos").alias("cos")))
    degree = stored(both.groupBy("component", "id").agg(F.count("*").alias("degree")))
    number = _numbered(degree.orderBy("component", "degree", "id").select("id"), "at")
    ends = both.join(number.withColumnRenamed("at", "src"), "id").join(number.select(F.col("id").alias("near"), F.col("at").alias("dst")), "near")
    ends = ends.repartition("component").sortWithinPartitions("component", "src", F.desc("cos"), "near").select("component", "src", "dst")
    return ends.mapInArrow(_walk_spilled, "component long, at long, path long, step long").join(number, "at").select("id", "component", "path", "step")


def walks(near: DataFrame, most: int = PIECE) -> DataFrame:
    """(id, component, path, step) for all texts that have a neighbour, of (id, near, cos).

    Each connected component is walked whole, along all of its links, by one task: up to ``most`` texts in memory,
    larger ones from disk.
    """
    near = stored(near)
    group = stored(components(near.select(F.col("id").alias("src"), F.col("near").alias("dst"))))
    links = near.join(group, "id").select("component", "id", "near", "cos")
    large = stored(group.groupBy("component").count().where(F.col("count") > most).select("component"))
    if large.isEmpty():
        return links.groupBy("component").applyInArrow(_walk_component, "id long, component long, path long, step long")
    small = links.join(large, "component", "left_anti").groupBy("component").applyInArrow(_walk_component, "id long, component long, path long, step long")
    return small.unionByName(_large_walks(links.join(large, "component", "left_semi")))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, k: int = K, gram: int = GRAM, span: int = SPAN, part_windows: int = PART_WINDOWS, often: int = OFTEN, hot: int = HOT, most: int = PIECE) -> DataFrame:
    """(part, window_id, position, doc_id, start, end): which tokens of which document fill each window.

    Tokens are the text's words; a document longer than what is left of a window goes on in the next.  Paths are
    laid end to end within a part; parts are filled independently, and only the last window of each is not full.
    Texts without neighbours are paths of their own.  Null texts and texts without a word take no room and are
    left out, as are rows without an id; rows that repeat an id count once, by the longest text.  Other columns are
    never read.  Ties are broken by id throughout.
    """
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("id"), text)
    every = stored(d.mapInArrow(_survey(gram, span, often), "id long, tokens long, size long, fingerprint long"))
    features = every.where("id is not null and tokens > 0").select("id", "tokens", "size")
    twice = stored(features.groupBy("id").count().where("count > 1").select("id"))
    if twice.count():  # only rows that repeat an id travel with their texts
        again = d.join(twice, "id", "left_semi").mapInArrow(_with_tokens, "id long, tokens long, text string")
        again = again.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("tokens"), "text"))).where("r = 1")
        d = stored(d.join(twice, "id", "left_anti").unionByName(again.select("id", F.col("text").alias(text))))
        features = features.groupBy("id").agg(F.max("tokens").alias("tokens"), F.max("size").alias("size"))
    total, prints = (x or 0 for x in features.agg(F.sum("tokens"), F.sum("size")).first())
    parts = max(1, -(-total // (window * part_windows)))
    near = neighbours(d, prints, hottest(every, hot), k, gram, span)
    laid = features.select("id", "tokens").join(walks(near, most), "id", "left").select(
        F.pmod(F.xxhash64(F.coalesce("component", "id")), F.lit(parts)).cast("int").alias("part"), "id", "tokens",
        F.coalesce("component", "id").alias("component"), F.coalesce("step", F.lit(0)).alias("step"))
    order = Window.partitionBy("part").orderBy("component", "step", "id")
    laid = laid.withColumn("to", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("from", F.col("to") - F.col("tokens"))
    cut = laid.select("part", "id", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / window), F.floor((F.col("to") - 1) / window))).alias("window_id"))
    start, end = F.greatest("from", F.col("window_id") * window), F.least("to", (F.col("window_id") + 1) * window)
    cut = cut.select("part", "window_id", "id", (start - F.col("window_id") * window).alias("offset"), (start - F.col("from")).alias("start"), (end - F.col("from")).alias("end"))
    return cut.select("part", "window_id", F.row_number().over(Window.partitionBy("part", "window_id").orderBy("offset")).alias("position"), F.col("id").alias("doc_id"), "start", "end")

"""MinHash near-dedup by min-max hashing.

Each of ``perms`` permutations of the shingle hashes gives two components, the minimum and the maximum, so a
signature of 2 x perms components costs perms evaluations.  Both agree with probability J, the Jaccard
similarity, and the two extremes of one permutation are all but independent, so the share of equal components
is an unbiased estimate of J with a lower variance than perms minima alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ids, list_array, slices, small, stored, unused
from .graph import components
from .textkernel import mix, shingles, words

SHINGLE, PERMS, BANDS, THRESHOLD = 3, 64, 32, 0.5
HOT, FEW, MANY = 100_000, 256, 4096  # members of a bucket put in order by one task; members of blocks compared
_CHUNK, _PAIRS, _TASK = 1 << 15, 1 << 15, 20_000


def permutations(perms: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607)
    return r.integers(0, 1 << 32, perms, np.uint32) | np.uint32(1), r.integers(0, 1 << 32, perms, np.uint32)


def signatures(x: np.ndarray, start: np.ndarray, perms: int) -> np.ndarray:
    """(texts, 2 x perms) uint32: minimum and maximum of each permutation; rows of texts without shingles stay 0."""
    a, b = permutations(perms)
    n = len(start) - 1
    out = np.zeros((n, 2 * perms), np.uint32)
    full = np.flatnonzero(np.diff(start) > 0)
    if not len(full):
        return out
    s = start[full]
    low = np.full((perms, len(full)), 0xFFFFFFFF, np.uint32)
    high = np.zeros((perms, len(full)), np.uint32)
    x = (x >> np.uint64(32)).astype(np.uint32)
    i = 0
    while i < len(x):  # pieces that stay in the cache
        j = min(len(x), i + _CHUNK)
        t0, t1 = np.searchsorted(s, i, "right") - 1, np.searchsorted(s, j, "left")
        cut = np.maximum(s[t0:t1] - i, 0)
        piece, h = x[i:j], np.empty(j - i, np.uint32)
        for p in range(perms):
            np.multiply(piece, a[p], out=h)
            np.add(h, b[p], out=h)
            np.minimum(low[p, t0:t1], np.minimum.reduceat(h, cut), out=low[p, t0:t1])
            np.maximum(high[p, t0:t1], np.maximum.reduceat(h, cut), out=high[p, t0:t1])
        i = j
    out[full, 0::2], out[full, 1::2] = low.T, high.T
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """(texts, bands) int64: a hash of the components of each band."""
    rows = sig.shape[1] // bands
    out = np.empty((len(sig), bands), np.uint64)
    for k in range(bands):
        x = np.full(len(sig), k + 1, np.uint64)
        for c in range(k * rows, (k + 1) * rows):
            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + sig[:, c])
        out[:, k] = x
    return out.view(np.int64)


def _sign(shingle: int, perms: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, first = words(b.column(1))
            x, start = shingles(h, first, shingle)
            sig = signatures(x, start, perms)
            keys = band_keys(sig, bands)
            whole = mix(keys.view(np.uint64).sum(1, dtype=np.uint64)).view(np.int64)
            has = np.diff(start) > 0
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(has)), pa.array([r.tobytes() for r in sig[has]], pa.binary()),
                 list_array(keys[has].ravel(), np.full(has.sum(), bands), pa.int64()), pa.array(whole[has])],
                ["id", "sig", "keys", "whole"])
    return run


def _similar(perms: int, threshold: float):
    """Rows (src, dst, a, b) whose signatures agree in at least ``threshold`` of the components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(-1, 2 * perms) for c in (b.column(2), b.column(3)))
            share = (x == y).mean(1)
            ok = share >= threshold
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(ok)), b.column(1).filter(pa.array(ok)), pa.array(share[ok])], ["src", "dst", "similarity"])
    return run


def _across(perms: int, threshold: float):
    """Of each (key, a, b) the members with role 0 against those with role 1: an edge where two components meet."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("a", "ascending"), ("b", "ascending"), ("role", "ascending"), ("id", "ascending")])
        key, a, b, role, own, part = (table[c].to_numpy() for c in ("key", "a", "b", "role", "id", "component"))
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint32).reshape(-1, 2 * perms)
        new = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        cut = np.concatenate([[0], np.flatnonzero(new) + 1, [len(key)]])
        src, dst, share = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for i, j in zip(cut, cut[1:]):
            m = i + int((role[i:j] == 0).sum())
            step = max(1, _PAIRS // max(1, j - m))
            for at in range(i, m, step):
                end = min(m, at + step)
                same = (sig[at:end, None] == sig[None, m:j]).mean(2)
                x, y = np.nonzero((same >= threshold) & (part[at:end, None] != part[None, m:j]))
                ends = np.sort(np.stack([part[at + x], part[m + y]]), 0)
                _, one = np.unique(ends, axis=1, return_index=True)  # one edge ties two components
                src.append(own[at + x[one]]), dst.append(own[m + y[one]]), share.append(same[x[one], y[one]])
        src, dst = np.concatenate(src), np.concatenate(dst)
        return pa.table({"src": np.maximum(src, dst), "dst": np.minimum(src, dst), "similarity": np.concatenate(share)})
    return run


def near_edges(signed: DataFrame, perms: int = PERMS, threshold: float = THRESHOLD, hot: int = HOT, few: int = FEW, many: int = MANY) -> DataFrame:
    """Verified edges (src, dst, similarity), src > dst; their components are those of all similar pairs of a bucket.

    Texts of one signature are tied to their smallest id.  Of the others, each bucket of a band ties every member to
    its smallest id and to its predecessor: as many edges as members, however large the bucket.  Mostly that joins all
    of a bucket.  Where it leaves several components, the members outside the largest are compared with all others of
    the bucket, in blocks of ``few`` by ``many``, so that no pair that could join two components is left out.  Buckets
    of more than ``hot`` members are put in order in parts.
    """
    own = stored(signed.groupBy("whole").agg(F.min("id").alias("rep")))  # of many copies, each partition sends one row
    reps = signed.select("id", "whole").join(own, "whole")
    same = reps.where("id <> rep").select(F.col("id").alias("src"), F.col("rep").alias("dst"), F.lit(1.0).alias("similarity"))
    sig = signed.select("id", "sig")
    lone = signed.join(own.select(F.col("rep").alias("id")), "id", "left_semi").select("id", F.explode("keys").alias("key"))
    buckets = stored(lone.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("n")).where("n > 1"))
    members = stored(lone.join(small(buckets), "key"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / hot))
    ties = members.select("id", "head", F.lag("id").over(Window.partitionBy("key", part).orderBy("id")).alias("before")).where("id <> head")
    pairs = ties.select(F.col("id").alias("src"), F.explode(F.array_distinct(F.array("head", F.coalesce("before", "head")))).alias("dst")).distinct()
    both = pairs.join(sig.toDF("src", "a"), "src").join(sig.toDF("dst", "b"), "dst").select("src", "dst", "a", "b")
    good = stored(both.mapInArrow(_similar(perms, threshold), "src long, dst long, similarity double"))
    group = stored(components(good))
    placed = members.join(small(group), "id", "left").withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("key", "component").agg(F.count("*").alias("held"))
    mixed = stored(sizes.groupBy("key").agg(F.max_by("component", F.struct("held", "component")).alias("largest"), F.count("*").alias("parts"), F.sum("held").alias("all"), F.max("held").alias("most")).where("parts > 1"))
    n = mixed.agg(F.sum("all")).first()[0]
    if not n:
        return same.unionByName(good)
    inside = placed.select("key", "id", "component").join(small(mixed), "key").join(sig, "id")
    rows, columns = F.ceil((F.col("all") - F.col("most")) / few), F.ceil(F.col("all") / many)
    cols = ["key", "a", "b", "role", "id", "component", "sig"]
    asked = inside.where("component <> largest").select("*", F.pmod(F.xxhash64("id"), rows).alias("a"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("b"), F.lit(0).alias("role"))
    others = inside.select("*", F.pmod(F.xxhash64("id"), columns).alias("b"), F.explode(F.sequence(F.lit(0), rows - 1)).alias("a"), F.lit(1).alias("role"))
    tasks = F.pmod(F.xxhash64("key", "a", "b"), F.lit(max(1, -(-n // _TASK)))).alias("task")
    rest = asked.select(cols).unionByName(others.select(cols)).select(tasks, "*").groupBy("task").applyInArrow(_across(perms, threshold), "src long, dst long, similarity double")
    return same.unionByName(good).unionByName(stored(rest))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, perms: int = PERMS, bands: int = BANDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, group_id, kept): groups of texts whose word ``shingle``-gram sets are alike, and which one stays.

    A group is a connected component of pairs with an estimated Jaccard similarity of at least ``threshold``; its
    id is its smallest document id, and that document is kept.  Texts without a word (null, empty, punctuation)
    are alike to nothing and kept.  Rows without an id are left out; rows that repeat an id count once, with all
    their texts.  Other columns are never read.
    """
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("id"), text)
    signed = stored(d.mapInArrow(_sign(shingle, perms, bands), "id long, sig binary, keys array<long>, whole long"))
    group = components(near_edges(signed, perms, threshold))
    every = d.select("id").distinct()
    return every.join(group, "id", "left").select(
        F.col("id").alias("doc_id"), F.coalesce("component", "id").alias("group_id"),
        (F.coalesce("component", "id") == F.col("id")).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The table with one document of each group of near copies; all columns as they are.

    The ids to drop are broadcast only where their counted size allows it, else both sides are shuffled by id.  Of
    rows that repeat an id the one of the smallest text stays; rows without an id stay.
    """
    gone, again, row = (unused(docs, x) for x in ("gone", "again", "row"))
    id_ = F.col(key).cast("long")
    drop = stored(near_duplicates(docs, key, text, **how).where(~F.col("kept")).select(F.col("doc_id").alias(gone)))
    rest = docs.join(small(drop), id_ == F.col(gone), "left_anti")
    twice = stored(docs.where(F.col(key).isNotNull()).groupBy(id_.alias(again)).count().where("count > 1").select(again))
    if twice.isEmpty():
        return rest
    # what can't be hashed, as maps can't, is hashed as JSON
    values = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields]
    first = Window.partitionBy(id_).orderBy(F.col(text).asc_nulls_last(), F.xxhash64(*values))
    return rest.join(small(twice), id_ == F.col(again), "left_anti").unionByName(
        rest.join(small(twice), id_ == F.col(again), "left_semi").withColumn(row, F.row_number().over(first)).where(F.col(row) == 1).drop(row))

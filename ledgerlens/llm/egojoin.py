"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are rotated to their principal axes, which keeps distances.  A cosine of at least ``threshold`` is a
distance of at most epsilon = sqrt(2 - 2 threshold), so near vectors lie in the same or adjacent grid cells of
width epsilon in every dimension.  Vectors are sorted by their cells on the leading axes; the sequence is cut into
blocks, and intervals of it are joined recursively, skipping those whose boxes are further apart than epsilon.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids, stored
from .graph import components

THRESHOLD, AXES, BLOCK, TILE, MOST_BLOCKS = 0.95, 8, 1024, 16, 1_000_000
SLACK = 1e-5  # float32 rounding may not lose a pair


def _matrix(c: pa.Array, dim: int) -> np.ndarray:
    return c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _units(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and unit vectors; what isn't finite or has no direction is left out."""
    for b in batches:
        if b.num_rows:
            x = _matrix(b.column(1), dim)
            n = np.linalg.norm(x, axis=1)
            ok = np.isfinite(n) & (n > 0)
            yield b.column(0).filter(pa.array(ok)), x[ok] / n[ok, None]


def _moments(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + dim * dim)
        for _, x in _units(batches, dim):
            total += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "sum"])
    return run


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Rows are the axes of the largest variance first; one pass, (dim + 1)**2 sums shuffled per partition."""
    got = vectors.mapInArrow(_moments(dim), "at int, sum double").groupBy("at").agg(F.sum("sum").alias("sum")).toPandas()
    s = np.zeros(1 + dim + dim * dim)
    s[got["at"]] = got["sum"]
    n = max(s[0], 1.0)
    mean = s[1 : dim + 1] / n
    values, axes = np.linalg.eigh(s[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean))
    return axes.T[np.argsort(-values, kind="stable")]


def _rotate(axes: np.ndarray, eps: float, lead: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, x in _units(batches, axes.shape[1]):
            y = (x @ axes.T).astype(np.float32)
            cell = np.floor(y[:, :lead].astype(np.float64) / eps).astype(np.int64) + (1 << 15)
            order = np.zeros(len(y), np.int64)
            for j in range(min(3, lead)):  # the sequence's order: three cell numbers here, the others within a block
                order = (order << 16) | np.clip(cell[:, j], 0, (1 << 16) - 1)
            yield pa.RecordBatch.from_arrays([key, pa.array(order), pa.array([c.tobytes() for c in cell.astype(">i8")], pa.binary()), pa.array([v.tobytes() for v in y], pa.binary())], ["id", "cell", "cells", "vector"])
    return run


def _blocks(dim: int, lead: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out(t: pa.Table) -> pa.RecordBatch:
            v = np.frombuffer(b"".join(t["vector"].to_pylist()), np.float32).reshape(-1, dim)[:, :lead]
            return pa.RecordBatch.from_arrays([
                pa.array([b"".join(t["cells"][:1].to_pylist())]), pa.array([t["id"].to_numpy().tobytes()]), pa.array([b"".join(t["vector"].to_pylist())]),
                pa.array([v.min(0).astype(np.float64).tolist()], pa.list_(pa.float64())), pa.array([v.max(0).astype(np.float64).tolist()], pa.list_(pa.float64()))], ["first", "ids", "vectors", "low", "high"])
        for b in batches:
            held.append(b), (n := n + b.num_rows)
            while n >= rows:
                t = pa.Table.from_batches(held)
                yield out(t.slice(0, rows))
                held, n = t.slice(rows).to_batches(), n - rows
        if n:
            yield out(pa.Table.from_batches(held))
    return run


def block_pairs(low: np.ndarray, high: np.ndarray, mine: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b), a <= b, for a in ``mine``: blocks whose boxes are no further apart than eps.

    A recursion over halves of the sequence: the part of ``mine`` that is near an interval's box goes on to its
    halves, the rest is dropped with all that the interval holds.
    """
    def far(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        gap = np.maximum(0, np.maximum(low[x] - hi, lo - high[x]))
        return (gap * gap).sum(1) > (eps + SLACK) ** 2

    out: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(mine, 0, len(low))]
    while todo:
        x, i, j = todo.pop()
        x = x[x < j]
        x = x[~far(x, low[i:j].min(0), high[i:j].max(0))] if len(x) else x
        if not len(x):
            continue
        if j - i == 1:
            x = x[x <= i]
            out.append((x, np.full(len(x), i)))
        else:
            todo += [(x, i, (i + j) // 2), (x, (i + j) // 2, j)]
    return tuple(np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else ([], [])))


def _join(dim: int, threshold: float, eps: float, boxes):
    """Of a tile's blocks, those in the first interval against those in the second, where their boxes are near."""
    def run(table: pa.Table) -> pa.Table:
        from .graph import _label

        low, high = boxes.value
        block, one, two = table["block"].to_numpy(), table["one"][0].as_py(), table["two"][0].as_py()
        vectors = {k: np.frombuffer(v, np.float32).reshape(-1, dim) for k, v in zip(block.tolist(), table["vectors"].to_pylist())}
        own = {k: np.frombuffer(v, np.int64) for k, v in zip(block.tolist(), table["ids"].to_pylist())}
        first, second = np.sort(block[block // TILE == one]), np.sort(block[block // TILE == two])
        ends = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a in first.tolist():
            mine = second[second >= a]
            gap = np.maximum(0, np.maximum(low[mine] - high[a], low[a] - high[mine]))
            for b in mine[(gap * gap).sum(1) <= (eps + SLACK) ** 2].tolist():
                x, y = vectors[a], vectors[b]
                src, dst = np.nonzero(x @ y.T >= threshold - SLACK)
                exact = np.einsum("ij,ij->i", x[src].astype(np.float64), y[dst].astype(np.float64)).round(6) >= threshold
                src, dst = own[a][src[exact]], own[b][dst[exact]]
                ends.append((src[src != dst], dst[src != dst]))
        src, dst = (np.concatenate(e) for e in zip(*ends))
        got = list(_label(iter([pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], ["src", "dst"])]))) if len(src) else []
        # only what connects: each vector with the smallest id that it is tied to here
        return pa.Table.from_batches(got).rename_columns(["src", "dst"]) if got else pa.table({"src": src, "dst": dst})
    return run


def near_edges(vectors: DataFrame, key: str, column: str, threshold: float, axes: int = AXES, rows: int = BLOCK) -> DataFrame | None:
    """(src, dst) whose connected components are those of all pairs of cosine >= threshold; None without vectors."""
    sizes = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return None
    dim, n = sizes["n"], sizes["count"]
    lead, eps = min(axes, dim), float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9
    rows = max(rows, -(-n // MOST_BLOCKS))  # the boxes stay broadcastable
    d = vectors.where(F.size(column) == dim).select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v")).where(~F.exists("v", lambda x: x.isNull()))
    axes_ = principal_axes(d, dim)
    cells = stored(d.mapInArrow(_rotate(axes_, eps, lead), "id long, cell long, cells binary, vector binary"))
    parts = max(1, -(-n // (rows * 4)))
    sequence = cells.repartitionByRange(parts, "cell", "cells").sortWithinPartitions("cells", "id")
    blocks = stored(sequence.mapInArrow(_blocks(dim, lead, rows), "first binary, ids binary, vectors binary, low array<double>, high array<double>"))
    boxes = blocks.select("first", F.substring("ids", 1, 8).alias("one"), "low", "high").orderBy("first", "one").toArrow()
    if not boxes.num_rows:
        return None
    low, high = (np.array(boxes[c].to_pylist()) for c in ("low", "high"))
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast((low, high))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = block_pairs(*shared.value, np.sort(b.column(0).to_numpy()), eps)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
    near = spark.range(len(low), numPartitions=max(1, -(-len(low) // 256))).mapInArrow(pairs, "a long, b long")
    # a block travels once to each tile of TILE by TILE blocks that has a near pair of it
    tile = [F.floor(F.col(c) / TILE) for c in ("a", "b")]
    needed = near.select(tile[0].alias("one"), tile[1].alias("two"), F.explode(F.array("a", "b")).alias("block")).distinct()
    named = blocks.join(spark.createDataFrame(pa.table({"block": np.arange(len(low)), "one": boxes["one"]})), F.substring("ids", 1, 8) == F.col("one")).select("block", "ids", "vectors")
    return needed.join(stored(named), "block").groupBy("one", "two").applyInArrow(_join(dim, threshold, eps, shared), "src long, dst long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD, axes: int = AXES, rows: int = BLOCK) -> DataFrame:
    """(vec_id, group_id, kept): groups of vectors connected by cosines of at least ``threshold``; the smallest id stays.

    The join is exact (cosines are compared when rounded to six digits).  Vectors that are null, empty, of another
    length than most, zero, or hold a null or something not finite are like nothing and kept.  Rows without an id
    are left out; rows that repeat an id count once, with all their vectors.  Other columns are never read.
    """
    d = ids(vectors, key, column)
    every = d.select(F.col(key).cast("long").alias("vec_id")).distinct()
    edges = near_edges(d, key, column, threshold, axes, rows)
    if edges is None:
        return every.select("vec_id", F.col("vec_id").alias("group_id"), F.lit(True).alias("kept"))
    group = components(edges).withColumnRenamed("id", "vec_id")
    return every.join(group, "vec_id", "left").select("vec_id", F.coalesce("component", "vec_id").alias("group_id"), (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))


ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND round(list_cosine_similarity(a.e, b.e), 6) >= {THRESHOLD}),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, n.b FROM reach r JOIN near n ON n.a = r.other)
SELECT vec_id, min(other) AS group_id, min(other) = vec_id AS kept FROM reach GROUP BY vec_id
"""

"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LOCAL_EDGES = 4_000_000  # up to here one task's arrays (about 200 MB) do it in one pass


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not got:
        return
    src, dst = (np.concatenate(x) for x in zip(*got))
    node, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = at[: len(src)], at[len(src) :]
    label = np.arange(len(node))
    while True:  # hook to the smaller root, then jump pointers
        x, y = label[a], label[b]
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
    for i in range(0, len(node), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(node[i : i + (1 << 16)]), pa.array(node[label[i : i + (1 << 16)]])], ["id", "component"])


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(id, component) for each node of (src, dst): component is the smallest id that the node is connected to.

    Null ends, loops and repeated edges don't matter; no edges give no rows.  Up to ``local_edges`` edges one task labels them all; beyond, alternating large-star and small-star rounds
    (each a shuffle by node, every round's edges written to the shared folder) run until nothing changes.
    """
    edges = stored(edges.select("src", "dst").where("src is not null and dst is not null"))
    if edges.count() <= local_edges:
        return edges.coalesce(1).mapInArrow(_label, "id long, component long")
    loops = edges.where("src = dst").select(F.col("src").alias("id"), F.col("src").alias("component"))
    now = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    before = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return found.union(roots).union(loops).groupBy("id").agg(F.min("component").alias("component"))

"""Shared plumbing: table access, scratch tables in the cluster's shared folder, Arrow helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

MAX_BROADCAST_BYTES = 256 << 20  # what one Python worker may hold of a broadcast side
ARROW_BYTES = 8 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"  # and Spark's own value


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers; let Arrow batches hold 8 MB of texts, where the session doesn't say otherwise."""
    ship(spark)
    if spark.conf.get(_ARROW[0], _ARROW[1]) == _ARROW[1]:
        spark.conf.set(_ARROW[0], f"{ARROW_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` if the session names one.

    Only where it is unset (tests, one machine) a temporary folder is made and set.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            base = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
            spark.sparkContext.setCheckpointDir(base)
        _roots[app] = f"{base.rstrip('/')}/ledgerlens-{app}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # the gateway is gone already; the folder's owner cleans up
        pass


def stored(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike a cached or locally checkpointed frame the files outlive any executor.
    """
    spark = df.sparkSession
    prepare(spark)
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    (df.repartition(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote once nothing will read it any more."""
    for df in frames:
        for f in df.inputFiles()[:1]:
            _remove(df.sparkSession, f.rsplit("/", 1)[0])


def cores(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def ids(docs: DataFrame, key: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table carries; rows without a key are left out."""
    prepare(docs.sparkSession)
    return docs.select(key, *more).where(F.col(key).isNotNull())


def one_text_per_id(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) with repeated ids reduced to the row of the smallest text.

    Ids alone are counted first; where none repeats, as in a sound table, the texts don't travel at all, and else
    only the repeated rows do.
    """
    d = ids(docs, key, text)
    twice = stored(d.groupBy(key).count().where("count > 1").select(key))
    n = twice.count()
    if not n:
        return d
    side = F.broadcast(twice) if n * 64 < MAX_BROADCAST_BYTES // 8 else twice
    return d.join(side, key, "left_anti").unionByName(d.join(side, key, "left_semi").groupBy(key).agg(F.min(text).alias(text)))


def unused(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small(keys: DataFrame, row_bytes: int = 64, most: int = MAX_BROADCAST_BYTES // 4) -> DataFrame:
    """Mark a stored key table for broadcast if its counted size allows; else leave the join to the planner."""
    return F.broadcast(keys) if keys.count() * row_bytes <= most else keys


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Split Arrow batches so that each holds about ``most`` bytes of text (one longer text stays whole)."""
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column(b.schema.get_field_index(column))
        if b.num_rows == 1 or c.nbytes <= most:
            yield b
            continue
        size = np.asarray(_lengths(c))
        group = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield b.slice(i, j - i)


def _lengths(c: pa.Array) -> np.ndarray:
    o = offsets(c)
    return np.diff(o)


def offsets(c: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array, from its own start on."""
    wide = pa.types.is_large_string(c.type) or pa.types.is_large_binary(c.type)
    o = np.frombuffer(c.buffers()[1], np.int64 if wide else np.int32, len(c) + c.offset + 1)
    return o[c.offset :].astype(np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    off = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(f, schema)

"""Keyed tables over immutable files: upserts, child replacement, pruning, cascades.

Each operation is a function from the old table and a batch to the new table, so it can be run again after a
failure; ``Table`` writes a new version beside the old one and then switches to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.collections import merge_json
from .relational import pick_per_key


def upsert(old: DataFrame, batch: DataFrame, keys: list[str], seq: str, now: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """``old`` with the rows of ``batch``, of which the last by ``seq`` counts for a key.

    created_at and the columns named in ``keep`` survive, as do those that only ``old`` has; updated_at is ``now`` for
    rows that the batch touches.  Both sides meet once, by key; rows without a key meet nothing and stay beside each other.
    """
    new = pick_per_key(batch, keys, F.desc(seq)).drop(seq)
    times = ("created_at", "updated_at")
    cols = [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in keys and c not in times]
    mine, theirs = set(new.columns), set(old.columns)
    both = old.alias("o").join(new.alias("n").withColumn("_new", F.lit(True)), keys, "full_outer")

    def pick(c: str) -> Column:
        if c not in mine:
            return F.col(f"o.{c}").alias(c)
        was = F.col(f"o.{c}") if c in theirs else F.lit(None)
        return F.when(F.col("_new"), F.coalesce(was, F.col(f"n.{c}")) if c in keep else F.col(f"n.{c}")).otherwise(was).alias(c)
    return both.select(*keys, *map(pick, cols), F.coalesce("o.created_at", now).alias("created_at"), F.when(F.col("_new"), now).otherwise(F.col("o.updated_at")).alias("updated_at"))


def sync_queue(old: DataFrame, batch: DataFrame, key: str, held: tuple[str, ...] = ("extracting", "parsed"), incoming: str = "pending_extraction", strict: bool = True) -> DataFrame:
    """(key, status, metadata): metadata merged shallowly, the new side's keys winning.

    A status in ``held`` survives, any other goes back to ``incoming``; with ``strict`` false needs_review survives too.
    """
    keeps = [*held] if strict else [*held, "needs_review"]
    both = old.alias("o").join(batch.alias("n").withColumn("_new", F.lit(True)), key, "full_outer")
    status = F.when(F.col("_new").isNull() | F.col("o.status").isin(keeps), F.col("o.status")).otherwise(F.lit(incoming))
    return both.select(key, status.alias("status"), merge_json("o.metadata", "n.metadata").alias("metadata"))


def update_by_key(table: DataFrame, changes: DataFrame, key: str, *columns: str, merge: tuple[str, ...] = ()) -> DataFrame:
    """Columns set from ``changes`` where it has a value for the key; nulls and blank texts keep the old one.

    Values may be of any type, vectors too; the JSON columns named in ``merge`` are merged shallowly.
    """
    c = changes.select(F.col(key).alias("_k"), *(F.col(x).alias(f"_{x}") for x in (*columns, *merge)))
    kept = lambda x: F.nullif(F.col(f"_{x}"), F.lit("")) if table.schema[x].dataType.simpleString() == "string" else F.col(f"_{x}").cast(table.schema[x].dataType)
    new = {x: F.coalesce(kept(x), F.col(x)) for x in columns} | {x: F.when(F.col("_k").isNotNull(), merge_json(x, f"_{x}")).otherwise(F.col(x)) for x in merge}
    return table.join(c, F.col(key) == F.col("_k"), "left").withColumns(new).select(*table.columns)


def replace_children(old: DataFrame, new: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """All children of ``parents`` make way for ``new``; a parent without new children is left without any."""
    return old.join(parents.select(parent).distinct(), parent, "left_anti").unionByName(new)


def prune(table: DataFrame, doomed: Column, live: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): rows of ``doomed`` whose key isn't in ``live`` go."""
    removed = table.where(doomed).join(live.select(key), key, "left_anti")
    kept = table.where(~F.coalesce(doomed, F.lit(False))).unionByName(table.where(doomed).join(live.select(key).distinct(), key, "left_semi").select(*table.columns))
    return kept, removed.select(*table.columns)


def cascade(children: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Children without those whose parent is gone."""
    return children.join(gone.select(key), key, "left_anti")


def orphans(children: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    return children.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


class Table:
    """A named table whose versions are folders; readers see the newest that was written whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs()
        if not fs.exists(p):
            return []
        have = [f.getPath() for f in fs.listStatus(p)]
        done = [f.getName() for f in have if f.getName().isdigit() and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
        return sorted(map(int, done))

    def read(self) -> DataFrame | None:
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/{v[-1]}") if v else None

    def write(self, df: DataFrame, history: int = 2) -> None:
        """The next version; of the older ones ``history`` stay for readers that have begun."""
        v = self.versions()
        df.write.mode("overwrite").parquet(f"{self.path}/{(v[-1] if v else 0) + 1}")
        fs, _ = self._fs()
        for x in v[: max(0, len(v) - history)]:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}"), True)

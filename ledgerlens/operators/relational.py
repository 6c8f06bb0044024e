"""Joins, per-key picks and nested aggregates that the domain's queries are made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def or_join(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[Column, Column], guard: Column) -> DataFrame:
    """left JOIN right ON first equal OR (guard AND second equal), as a union of two equi-joins.

    ``guard`` (on right) has to exclude the first condition, as "its first key is blank" does; a disjunction in one
    join condition would be planned as a cross product.
    """
    a = left.join(right.where(~guard), F.col(first[0]) == F.col(first[1]))
    b = left.join(right.where(guard), second[0] == second[1])
    return a.unionByName(b)


def pick_per_key(df: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in ``order``, which should be total; a window's group limit cuts early."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def only_missing(df: DataFrame, key: Column, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose computed key isn't in ``known``."""
    return df.withColumn("_key", key).join(known.select(F.col(known_key).alias("_key")), "_key", "left_anti").drop("_key")


def lookup_members(df: DataFrame, key: str, array: str, other: DataFrame, other_key: str, value: Column, out: str) -> DataFrame:
    """For an array of keys the sorted distinct values that they have in ``other``; an empty array if none."""
    hits = df.select(key, F.explode(array).alias("_item")).join(other.select(F.col(other_key).alias("_item"), value.alias("_value")), "_item")
    found = hits.groupBy(key).agg(F.array_sort(F.collect_set("_value")).alias(out))
    kind = found.schema[out].dataType
    return df.join(found, key, "left").withColumn(out, F.coalesce(out, F.array().cast(kind)))


def bundle(parent: DataFrame, key: str, **children: DataFrame) -> DataFrame:
    """Parents with a list of structs from each child table, ordered by the structs' fields; empty if none."""
    for name, child in children.items():
        rows = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[c for c in child.columns if c != key]))).alias(name))
        kind = rows.schema[name].dataType
        parent = parent.join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return parent


def or_activity(left: DataFrame, right: DataFrame, key: str, ticker: str, at: str) -> DataFrame:
    """``left`` with trade_count and latest of the rows of ``right`` that have its key or, without a key, its ticker.

    Counts and maxima add up, so the right side is aggregated by each of the two before it meets the left one.
    """
    by = lambda rows, c: rows.groupBy(c).agg(F.count("*").alias("_n"), F.max(at).alias("_at"))
    a, b = by(right.where(F.col(key).isNotNull()), key), by(right.where(F.col(key).isNull()), ticker)
    both = left.join(a, key, "left").join(b.toDF(ticker, "_n2", "_at2"), ticker, "left")
    return both.withColumn("trade_count", F.coalesce("_n", F.lit(0)) + F.coalesce("_n2", F.lit(0))).where("trade_count > 0").withColumn("latest", F.greatest("_at", "_at2")).drop("_n", "_n2", "_at", "_at2")


def status_counts(tables: dict[str, DataFrame], **parts: dict[str, Column]) -> DataFrame:
    """(counter, n): rows of each table and of its parts that conditions name, one pass a table."""
    out = None
    for name, df in tables.items():
        counters = {name: F.lit(True)} | parts.get(name, {})
        one = df.agg(*(F.count(F.when(c, 1)).alias(k) for k, c in counters.items())).select(F.explode(F.array(*(F.struct(F.lit(k).alias("counter"), F.col(k).alias("n")) for k in counters))).alias("_c")).select("_c.*")
        out = one if out is None else out.unionByName(one)
    return out


def best_candidate(df: DataFrame, key: str, *order: Column) -> DataFrame:
    return pick_per_key(df, [key], *order)

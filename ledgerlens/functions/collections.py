"""Arrays, maps, JSON and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def ordered_list(value: Column, *keys: Column, where: Column | None = None) -> Column:
    """Aggregate: values ordered by keys (nulls first); rows that ``where`` excludes don't count; empty if none."""
    row = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)), value.alias("value"))
    held = F.collect_list(row if where is None else F.when(where, row))
    return F.transform(F.array_sort(held), lambda x: x["value"])


def sorted_set(value: Column) -> Column:
    """Aggregate: distinct values in order."""
    return F.array_sort(F.collect_set(value))


def count_map(key: Column, count: Column) -> Column:
    """Aggregate over one row a key: JSON object of counts, keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, count)))))


def json_text(x: Column | str, key: str) -> Column:
    return F.get_json_object(_c(x), f"$.{key}")


def merge_json(old: Column | str, new: Column | str) -> Column:
    """Shallow merge of two JSON objects; the new one's keys win, values keep their types; null counts as empty."""
    a, b = (F.coalesce(F.try_parse_json(_c(x)), F.parse_json(F.lit("{}"))).cast("map<string,variant>") for x in (old, new))
    return F.to_json(F.map_concat(F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k)), b))


def drop_empty(m: Column) -> Column:
    """A map without keys of null or blank values."""
    return F.map_filter(m, lambda k, v: F.coalesce(F.trim(v), F.lit("")) != "")


def string_list(x: Column | str) -> Column:
    """A list of strings from JSON text: an array's entries, one for a scalar, none for blank."""
    x = _c(x)
    return F.when(F.coalesce(F.trim(x), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(x, "array<string>"), F.array(x)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null if either is null or without length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))

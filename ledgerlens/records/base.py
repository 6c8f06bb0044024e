"""What the record builders share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.collections import drop_empty
from ..functions.text import blank_to_null


def pick(row: Column, *keys: str) -> Column:
    """The first value under any of the keys that isn't blank, trimmed."""
    return F.coalesce(*(blank_to_null(row[k]) for k in keys))


def lines(*parts: Column, by: str = "\n") -> Column:
    """Parts that aren't blank, joined; an empty text if there are none."""
    return F.concat_ws(by, *(F.when(F.coalesce(F.trim(p), F.lit("")) != "", p) for p in parts))


def labelled(label: str, value: Column) -> Column:
    """"Label: value", or null without a value."""
    value = value.cast("string")
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))


def raw(row: Column) -> Column:
    """What the row had, as JSON without empty values."""
    return F.to_json(drop_empty(row))


def tags(*parts: Column | str, keep_empty: bool = False) -> Column:
    """Distinct tags in order, of texts and lists of texts; null is none, an empty one only stays if asked for."""
    one = [F.array(F.lit(p)) if isinstance(p, str) else p for p in parts]
    every = F.array_distinct(F.array_compact(F.concat(*one)))
    return every if keep_empty else F.filter(every, lambda t: t != "")


def one(x: Column, keep_empty: bool = False) -> Column:
    """A list of a value, empty for null (and for blank)."""
    return F.array_compact(F.array(x if keep_empty else blank_to_null(x)))


def texts(x: Column) -> Column:
    """A list of trimmed texts without blank ones; null is an empty list."""
    return F.filter(F.transform(F.coalesce(x, F.array().cast("array<string>")), lambda v: F.trim(v)), lambda v: F.coalesce(v, F.lit("")) != "")


def joined(x: Column, n: int | None = None, by: str = ", ") -> Column:
    """A list's (first n) texts in one; null if there are none."""
    return F.nullif(F.array_join(F.slice(x, 1, n) if n else x, by), F.lit(""))


def money(x: Column, places: int = 0) -> Column:
    """$1,234, halves to even."""
    return F.concat(F.lit("$"), F.format_number(F.bround(x.cast("double"), places), places))


def by_value(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))


def same_person(*columns: str) -> Column:
    """What a name is looked up by, in one text: equal for rows that are looked up alike."""
    return F.concat_ws("\x1f", *(F.coalesce(F.col(c), F.lit("")) for c in columns))

"""Amounts: ranges in text, buckets, tolerant conversion, display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, blank_to_null, strip_ws

#: Upper ends of the disclosure brackets; each begins one above the end before, the first at 1,001.
BRACKETS = [15_000, 50_000, 100_000, 250_000, 500_000, 1_000_000, 5_000_000, 25_000_000, 50_000_000]


def bracket(x: Column | str) -> Column:
    """(low, high) of the bracket that an amount falls into; over the last one up to twice its end; (0, 0) below."""
    x, out, low = _c(x), F.struct(F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high")), 1_001
    chain = F.when(x < 1_001, out)
    for high in BRACKETS:
        chain = chain.when(x <= high, F.struct(F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high")))
        low = high + 1
    return chain.when(x.isNotNull(), F.struct(F.lit(low).cast("long").alias("low"), F.lit(2 * BRACKETS[-1]).cast("long").alias("high"))).otherwise(out)


def bracket_text(x: Column | str) -> Column:
    """(low, high) of a House form's bracket in a text; (0, 0) if it is none of them."""
    x, low = _c(x), 1_001
    pair = lambda a, b: F.struct(F.lit(a).cast("long").alias("low"), F.lit(b).cast("long").alias("high"))
    chain = None
    for high in BRACKETS:
        test = x.rlike(rf"\${low:,}\s*-\s*\${high:,}")
        chain = chain.when(test, pair(low, high)) if chain is not None else F.when(test, pair(low, high))
        low = high + 1
    return chain.when(x.rlike(rf"(?i)Over\s*\${low - 1:,}"), pair(low, 2 * (low - 1))).otherwise(pair(0, 0))


def parse_range(x: Column | str) -> Column:
    """(low, high) of "$a - $b", "over $n" (n, n) or "$n" (n, n); (0, 0) for any other text."""
    t = F.lower(strip_ws(F.regexp_replace(F.coalesce(_c(x), F.lit("")), "[$,]", "")))
    digits = lambda v: F.when(v.rlike(r"^\d+$"), v.try_cast("long"))
    one = F.coalesce(digits(t), digits(strip_ws(F.regexp_extract(t, r"^over (.*)$", 1))))
    parts = F.transform(F.split(t, "-"), strip_ws)
    a, b = digits(parts[0]), digits(F.get(parts, F.lit(1)))
    two = (F.size(parts) == 2) & a.isNotNull() & b.isNotNull()
    pair = lambda a, b: F.struct(a.cast("long").alias("low"), b.cast("long").alias("high"))
    return F.when(two, pair(a, b)).when(one.isNotNull(), pair(one, one)).otherwise(pair(F.lit(0), F.lit(0)))


def to_double(x: Column | str) -> Column:
    """A number from text with thousands separators; null if it isn't one."""
    return F.regexp_replace(blank_to_null(x), ",", "").try_cast("double")


def to_long(x: Column | str) -> Column:
    return to_double(x).cast("decimal(38,6)").try_cast("long")


def dollars(x: Column | str) -> Column:
    """$1,234 without cents, halves to even."""
    return F.concat(F.lit("$"), F.format_number(F.bround(_c(x), 0), 0))

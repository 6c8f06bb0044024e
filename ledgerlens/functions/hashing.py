"""Content keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def joined(*xs: Column | str) -> Column:
    """Parts joined by |; null parts are empty, never left out."""
    return F.concat_ws("|", *(F.coalesce(_c(x).cast("string"), F.lit("")) for x in xs))


def sha1_key(*xs: Column | str) -> Column:
    return F.sha1(joined(*xs))


def sha256_key(*xs: Column | str, length: int = 64) -> Column:
    return F.substring(F.sha2(joined(*xs), 256), 1, length)


def trade_id(kind: Column, source: Column, source_id: Column, member: Column, ticker: Column, description: Column, action: Column, day: Column, low: Column, high: Column, owner: Column, url: Column) -> Column:
    """tr-house-... from the filing's line, tr-senate-... from the trade's content, tr-<source>-... otherwise."""
    lower = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    content = sha256_key(member, F.upper(F.trim(F.coalesce(ticker, F.lit("")))), F.lower(F.trim(F.regexp_replace(description, r"\s+", " "))), lower(action), F.coalesce(day, F.lit("")),
                         F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(0)), lower(F.coalesce(owner, F.lit("self"))), F.regexp_replace(lower(url), "/+$", ""), length=16)
    dash = lambda c: F.replace(c, F.lit(":"), F.lit("-"))
    return (F.when(kind == "house-ptr", F.concat(F.lit("tr-house-"), dash(source_id))).when(kind == "senate-trade", F.concat(F.lit("tr-senate-"), content))
            .otherwise(F.concat(F.lit("tr-"), dash(source), F.lit("-"), dash(source_id))))

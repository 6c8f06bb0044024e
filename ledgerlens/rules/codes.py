"""Code tables of the disclosure forms as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import _c

HOUSE_ASSETS = {"ST": "Stock", "OP": "Option", "MF": "Mutual Fund", "ETF": "ETF", "GS": "Government Security", "CS": "Corporate Security"}


def house_action(x: Column | str) -> Column:
    x = F.upper(F.trim(_c(x)))
    return F.when(x.startswith("S"), "sale").when(x.startswith("E"), "exchange").otherwise("purchase")


def house_asset(x: Column | str) -> Column:
    table = F.create_map(*(F.lit(v) for kv in HOUSE_ASSETS.items() for v in kv))
    return F.coalesce(table[F.upper(F.trim(_c(x)))], F.lit("Asset"))


def owner(prefix: Column | str, hint: Column | str) -> Column:
    """Whose an asset is, from codes in its description or beside it: spouse before joint before child before self."""
    x = F.upper(F.concat_ws(" ", F.coalesce(_c(prefix), F.lit("")), F.coalesce(_c(hint), F.lit(""))))
    return F.when(x.rlike(r"\b(?:SPOUSE/DC|SP)\b"), "spouse").when(x.rlike(r"\bJT\b"), "joint").when(x.rlike(r"\bDC\b"), "child").otherwise("self")


def senate_action(x: Column | str) -> Column:
    x = F.lower(F.trim(F.coalesce(_c(x), F.lit(""))))
    return F.when(x.startswith("sale"), "sale").when(x == "exchange", "exchange").when(x.contains("receive"), "receive").otherwise("purchase")


def senate_owner(x: Column | str) -> Column:
    x = F.lower(F.trim(F.coalesce(_c(x), F.lit(""))))
    return F.when(x.isin("spouse", "child", "joint"), x).otherwise("self")


def senate_asset(x: Column | str) -> Column:
    x = F.lower(F.trim(F.coalesce(_c(x), F.lit(""))))
    return F.when(x.contains("etf"), "ETF").when(x.contains("option"), "Option").when(x.contains("bond"), "Bond").when(x.contains("fund"), "Fund").otherwise("Stock")


def retryable(error: Column | str) -> Column:
    """Whether an error's text tells of something that may pass: a report not there yet, a time-out, a lost connection."""
    return F.coalesce(_c(error).rlike("(?i)PTR PDF fetch failed with 404|timeout|timed out|connection reset|temporarily unavailable"), F.lit(False))


def outcome(trades: Column, member: Column, confidence: Column, error: Column) -> Column:
    """A report's status after an extraction: back in the queue, parsed, or for review."""
    sound = (F.coalesce(trades, F.lit(0)) > 0) & (F.coalesce(member.cast("string"), F.lit("")) != "") & (F.coalesce(confidence, F.lit(0.0)) >= 0.6)
    return F.when(retryable(error), "pending_extraction").when(error.isNull() & sound, "parsed").otherwise("needs_review")

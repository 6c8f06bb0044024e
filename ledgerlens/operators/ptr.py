"""House periodic transaction reports: text to transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_issue, iso_from_us
from ..functions.hashing import joined
from ..functions.money import bracket_text
from ..functions.text import _c, bound, squeeze, strip_ws
from ..rules.codes import house_action, house_asset, owner
from .relational import pick_per_key

_OWNERS = "Spouse/DC|JT|DC|SP|TR|XX"
_DATE = r"\d{1,2}/\d{1,2}/\d{4}"
#: asset, ticker, asset code, action, transaction and notification date, owner, amount
ROW = (r"(?i)((?:[A-Z]{1,3}\s+)?[^\[]{6,240}?)" + r"(?:\s*\(([A-Z.]{1,6})\))?" + r"\s*\[([A-Z]{2,4})\]" + r"\s*(P|E|S(?:\s*\(partial\))?)"
       + rf"\s*({_DATE})\s*({_DATE})" + rf"\s*(?:({_OWNERS})\s+)?" + r"(Over\s*\$[\d,]+|\$[\d,]+\s*-\s*\$[\d,]+)" + r"(?:\s+[A-Z])?")
_FIELDS = ["asset", "ticker", "code", "action", "day", "notified", "owner_code", "amount"]


def clean_text(x: Column | str) -> Column:
    """One line without NULs, odd quotes and spaces, bullets, or spaces inside brackets."""
    x = F.translate(_c(x), "\u2019\u00a0\n\r\t\u2022\u0000", "'     ")
    return squeeze(F.replace(F.replace(x, F.lit(" )"), F.lit(")")), F.lit("( "), F.lit("(")))


def clean_asset(x: Column, ticker: Column) -> Column:
    """An asset's name out of what the page put around it; never blank."""
    x = squeeze(F.regexp_replace(x, r"(?i)\* For the complete list of asset type abbreviations.*$", ""))
    for noise in (r"^.*?\b[A-Z][a-z]+ Schwab \d+\s*", r"^.*?\b\d{3,}\s+", r"(?i)^.*?\bOwner Asset Transaction Type Date Notification Date Amount\s*",
                  r"(?i)^.*?\bName:\s+.*?\bState/District:\s+[A-Z]{2}\d*\s*", rf"(?i)^\s*(?:{_OWNERS}|[A-Z])\s+"):
        x = F.regexp_replace(x, noise, "")
    new = r"(?i)^(?:[A-Z]\s+)?S:\s+New\s+S\s+O:\s+.+?\bD:\s+(.+)$"
    described = r"(?i)^.*?(?:Trust\s+)?D:\s+(.+)$"
    x = bound(x, lambda v: F.when(v.rlike(new), F.trim(F.regexp_extract(v, new, 1)))
              .when(v.rlike(described) & v.rlike(r"(?i)Trust|S O:|Investment Fund|Capital call"), F.trim(F.regexp_extract(v, described, 1))).otherwise(v))
    for noise, to in ((r"(?i)^(?:F\s+)?S:\s+New\s+", ""), (r"(?i)^S\s+O:\s+", ""), (r"(?i)^Trust\s+", ""), (r"(?i)^Capital Call\b", "Capital call"), (rf"(?i)^\s*(?:{_OWNERS})\s+", ""), (r"\s+\*\s*$", "")):
        x = F.regexp_replace(x, noise, to)
    placed = r"(?i)^(.+?,\s+[A-Za-z .'-]+,\s+[A-Z]{2})\s+([A-Z][A-Za-z0-9 .,&'/-]+)$"
    x = bound(squeeze(x), lambda v: F.when(v.rlike(placed), F.concat(F.trim(F.regexp_extract(v, placed, 2)), F.lit(" ("), F.trim(F.regexp_extract(v, placed, 1)), F.lit(")"))).otherwise(v))
    x = F.regexp_replace(x, rf"(?i)^\s*(?:{_OWNERS})\s+", "")
    x = F.trim(F.regexp_replace(x, r"(?i)^.+?\b(?:JT|DC|SP|TR|Spouse/DC)\s+", ""))
    tail = F.concat(F.lit("("), ticker, F.lit(")"))
    x = bound(x, lambda v: F.when(ticker.isNotNull() & v.endswith(tail), F.trim(F.substring(v, F.lit(1), F.length(v) - F.length(tail)))).otherwise(v))
    return bound(x, lambda v: F.coalesce(F.when(v != "", v), ticker, F.lit("Pending House PTR extraction")))


def transactions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each transaction that a report's text lists, numbered as they stand there."""
    body = F.regexp_replace(clean_text(text), r"(?i)^.*?\bCap\.\s*Gains\s*>\s*\$200\?\s*", "")
    # the text is searched once: NULs, of which it has none left, come round what a match holds, and it is split by them
    n = len(_FIELDS)
    marked = F.split(F.regexp_replace(body, ROW, "\u0000" + "".join(f"${i + 1}\u0000" for i in range(n))), "\u0000")
    none = F.array().cast("array<array<string>>")
    found = bound(marked, lambda p: F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(0), F.floor(F.size(p) / (n + 1)).cast("int") - 1), lambda i: F.slice(p, i * (n + 1) + 2, n))).otherwise(none))
    rows = docs.select("*", F.posexplode(found).alias("_pos", "_match"))
    r = {f: F.col("_match")[i] for i, f in enumerate(_FIELDS)}
    ticker = F.nullif(r["ticker"], F.lit(""))
    amount = bracket_text(r["amount"])
    return rows.select(*docs.columns, (F.col("_pos") + 1).alias("line_number"), clean_asset(strip_ws(r["asset"]), ticker).alias("asset_description"), ticker.alias("ticker"), house_asset(r["code"]).alias("asset_type"),
                       house_action(r["action"]).alias("transaction_type"), iso_from_us(r["day"]).alias("transaction_date"), iso_from_us(r["notified"]).alias("notification_date"),
                       amount["low"].alias("amount_min"), amount["high"].alias("amount_max"), owner(r["asset"], r["owner_code"]).alias("owner"))


def dedupe(rows: DataFrame, doc_id: str = "doc_id", url: str = "source_url") -> DataFrame:
    """The first of transactions alike in all that identifies one; line numbers keep their gaps."""
    asset = F.coalesce(F.nullif(F.upper(F.trim("ticker")), F.lit("")), F.lower(squeeze("asset_description")))
    key = F.sha2(joined(doc_id, F.lower(F.trim(F.coalesce(url, F.lit("")))), asset, "transaction_type", "transaction_date", "notification_date", "amount_min", "amount_max", "owner"), 256)
    return pick_per_key(rows.withColumn("_key", key), ["_key"], F.asc("line_number")).drop("_key")


def confidence(dated: Column, priced: Column, tickers: Column, total: Column, named: Column) -> Column:
    """0 without transactions; else from how many have a date, an amount and a ticker, and from a known member."""
    score = F.lit(0.35) + F.when(named, 0.25).otherwise(0.0) + F.least(F.lit(0.2), dated * 0.05) + F.least(F.lit(0.15), priced * 0.04) + F.least(F.lit(0.1), tickers * 0.03)
    return F.when(total == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.95), F.bround(score, 2))))


def parse(docs: DataFrame, today: Column, filing: str = "filing_date", member: str = "member_name") -> tuple[DataFrame, DataFrame]:
    """(results, transactions): valid, distinct transactions and one result row a report with its confidence.

    A header's name and state go before the feed's.  ``docs`` has doc_id, text, source_url, ``filing`` and ``member``.
    """
    valid = dedupe(transactions(docs)).where(date_issue("transaction_date", filing, today).isNull())
    counts = valid.groupBy("doc_id").agg(F.count("*").alias("n"), F.count("transaction_date").alias("dated"), F.count(F.when(F.col("amount_max") > 0, 1)).alias("priced"), F.count("ticker").alias("tickers"))
    text = clean_text("text")
    header = F.nullif(squeeze(F.regexp_replace(F.regexp_extract(text, r"(?i)Name:\s+([^:]+?)\s+Status:", 1), r"(?i)^Hon\.\s*", "")), F.lit(""))
    state = F.nullif(F.upper(F.regexp_extract(text, r"(?i)State/District:\s+([A-Z]{2})\d*", 1)), F.lit(""))
    n = lambda c: F.coalesce(c, F.lit(0))
    results = docs.join(counts, "doc_id", "left").select(
        "doc_id", F.coalesce(header, F.col(member)).alias("member_name"), state.alias("state"), n("n").alias("n_transactions"),
        confidence(n("dated"), n("priced"), n("tickers"), n("n"), F.coalesce(F.col(member), F.lit("")) != "").alias("parser_confidence"), F.substring(text, 1, 1200).alias("raw_text_preview"))
    return results, valid

"""House and Senate trades: from feeds and parsed reports to rows of the trades table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import senate_date
from ..functions.hashing import trade_id
from ..functions.money import parse_range
from ..functions.text import blank_to_null, first_filled
from ..operators.resolve import resolve
from ..rules.codes import senate_action, senate_asset, senate_owner
from ..rules.crypto import asset_type, classify
from .base import by_value, same_person

SOURCES = {"senate-ethics": "senate_efd"}  # those not spelt alike but for the dash
TRADE = ["member_id", "source", "disclosure_kind", "source_id", "source_url", "ticker", "asset_description", "asset_type", "transaction_type", "transaction_date", "disclosure_date", "amount_min", "amount_max", "owner", "comment", "parser_confidence", "crypto"]


def stored_source(x: Column) -> Column:
    """A source's name as the stored tables spell it."""
    return F.coalesce(by_value(SOURCES)[x], F.replace(x, F.lit("-"), F.lit("_")))


def _id(kind: Column) -> Column:
    c = F.col
    return trade_id(kind, c("source"), c("source_id"), c("member_id"), c("ticker"), c("asset_description"), c("transaction_type"), c("transaction_date"), c("amount_min"), c("amount_max"), c("owner"), c("source_url"))


def house_trades(stubs: DataFrame, results: DataFrame, transactions: DataFrame) -> DataFrame:
    """A trade for each parsed transaction of a report (doc_id), with its stub's member, dates and link."""
    own = transactions.select("doc_id", "line_number", "ticker", "asset_description", "asset_type", "transaction_type", "transaction_date", "amount_min", "amount_max", "owner")
    t = own.join(results.select("doc_id", F.col("parser_confidence").alias("_sure")), "doc_id").join(stubs.select("doc_id", "member_id", "source_url", F.col("filing_date").alias("disclosure_date")), "doc_id")
    t = t.withColumn("crypto", classify("ticker", "asset_description"))
    comment = F.concat(F.lit("Parsed from House PTR "), F.col("doc_id"), F.lit(" at "), F.bround(F.col("_sure") * 100, 0).cast("int"), F.lit("% confidence"))
    return t.select("member_id", F.lit("house-clerk").alias("source"), F.lit("house-ptr").alias("disclosure_kind"), F.concat_ws(":", "doc_id", "line_number").alias("source_id"), "source_url", "ticker", "asset_description",
                    asset_type(F.col("crypto.kind"), F.col("asset_type")).alias("asset_type"), "transaction_type", "transaction_date", "disclosure_date", "amount_min", "amount_max", "owner", comment.alias("comment"), F.col("_sure").alias("parser_confidence"), "crypto")


def _senate(rows: DataFrame, members: DataFrame, source: str) -> DataFrame:
    """Rows with _name, _bioguide, _state and the trade's columns; those without a name, a day or a known member go."""
    rows = rows.where("_name is not null and transaction_date is not null").withColumn("_row", same_person("_name", "_state", "_bioguide"))
    keyed = rows.select(F.col("_row").alias("row_id"), F.col("_name").alias("name"), F.col("_state").alias("state"), F.col("_bioguide").alias("bioguide")).distinct()
    who = resolve(keyed, members, bioguide="bioguide").where("member_id is not null").select(F.col("row_id").alias("_row"), F.col("member_id").cast("string").alias("member_id"))
    t = rows.join(who, "_row").withColumn("asset_description", F.coalesce("_description", "ticker", F.lit("Unknown asset")))
    t = t.withColumn("crypto", classify("ticker", "asset_description")).withColumn("_range", parse_range("_amount"))
    t = t.select("member_id", F.lit(source).alias("source"), F.lit("senate-trade").alias("disclosure_kind"), F.lit("").alias("source_id"), "source_url", "ticker", "asset_description", asset_type(F.col("crypto.kind"), senate_asset("_kind")).alias("asset_type"),
                 senate_action("_action").alias("transaction_type"), "transaction_date", "disclosure_date", F.col("_range.low").alias("amount_min"), F.col("_range.high").alias("amount_max"), senate_owner("_owner").alias("owner"), "comment", F.lit(None).cast("double").alias("parser_confidence"), "crypto")
    return t.withColumn("source_id", _id(F.col("disclosure_kind")))


def watcher_trades(rows: DataFrame, members: DataFrame) -> DataFrame:
    ticker = F.upper(blank_to_null("ticker"))
    none = F.lit(None).cast("string")
    return _senate(rows.select(
        blank_to_null("senator").alias("_name"), none.alias("_bioguide"), none.alias("_state"), senate_date("transaction_date").alias("transaction_date"), none.alias("disclosure_date"), F.when(ticker != "--", ticker).alias("ticker"),
        blank_to_null("asset_description").alias("_description"), F.col("amount").alias("_amount"), F.col("type").alias("_action"), F.col("asset_type").alias("_kind"), F.col("owner").alias("_owner"),
        blank_to_null("ptr_link").alias("source_url"), blank_to_null("comment").alias("comment")), members, "senate-watcher")


def bulk_trades(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Senate trades of the bulk feed, or of the live one in its columns; rows of the other chamber go."""
    some = lambda *xs: F.coalesce(*(F.nullif(F.col(x), F.lit("")) for x in xs))
    none = F.lit(None).cast("string")
    chamber = F.lower(blank_to_null(some("Chamber", "House")))
    return _senate(rows.where(chamber == "senate").select(
        blank_to_null(some("Name", "Representative")).alias("_name"), F.upper(blank_to_null("BioGuideID")).alias("_bioguide"), F.upper(blank_to_null("State")).alias("_state"), senate_date(some("TransactionDate", "Traded")).alias("transaction_date"),
        senate_date(some("Filed", "ReportDate", "QuiverUploadTime")).alias("disclosure_date"), F.upper(blank_to_null("Ticker")).alias("ticker"), first_filled("Description", "Company").alias("_description"), some("Trade_Size_USD", "Amount").alias("_amount"),
        F.col("Transaction").alias("_action"), F.col("TickerType").alias("_kind"), F.lit("self").alias("_owner"), none.alias("source_url"), F.nullif(F.concat_ws(" | ", blank_to_null("Subholding"), blank_to_null("Comments")), F.lit("")).alias("comment")), members, "senate-quiver")


def newest_first(trades: DataFrame, latest_known: str | None = None, limit: int = 0) -> DataFrame:
    """Trades in the order of a feed, the newest disclosure first, none from before the latest day known."""
    day = F.coalesce("disclosure_date", "transaction_date")
    t = trades.where(day >= latest_known) if latest_known else trades
    t = t.orderBy(F.desc_nulls_last(day), "source_id")
    return t.limit(limit) if limit > 0 else t


def payload(trades: DataFrame) -> DataFrame:
    """Rows of the trades table; trades without a member aren't stored."""
    told = F.col("crypto.kind") != "unrelated"
    return trades.where("member_id is not null").select(
        _id(F.col("disclosure_kind")).alias("id"), "member_id", "ticker", "asset_description", "asset_type", "transaction_type", "transaction_date", "disclosure_date", "amount_min", "amount_max", "owner", "comment",
        stored_source(F.col("source")).alias("source"), F.coalesce("source_url", F.lit("")).alias("source_url"), F.lit(0.0).alias("conflict_score"), F.array().cast("array<string>").alias("conflict_flags"),
        *(F.when(told, F.col(f"crypto.{a}")).alias(f"crypto_{b}") for a, b in (("kind", "kind"), ("symbol", "symbol"), ("confidence", "match_confidence"))))


STUB = {"docId": "doc_id", "filingYear": "filing_year", "filingType": "filing_type", "filingDate": "filing_date", "firstName": "first_name", "lastName": "last_name", "memberId": "member_id", "memberName": "member_name", "memberSlug": "member_slug", "party": "party", "state": "state", "district": "district", "rawStateDistrict": "raw_state_district"}


def stub_payload(stubs: DataFrame) -> DataFrame:
    """Rows of the queue of reports: everything about a filing is in its metadata."""
    have = {c.lower() for c in stubs.columns}
    meta = F.to_json(F.struct(*((F.col(c) if c in have else F.lit(None).cast("string")).alias(k) for k, c in STUB.items())), {"ignoreNullFields": "false"})
    return stubs.select("doc_id", "filing_year", "source", "source_url", F.lit("pending_extraction").alias("status"), meta.alias("metadata"))


def stubs_of(queue: DataFrame) -> DataFrame:
    """Filings out of stored queue rows, as ``stub_payload`` put them there."""
    m = lambda k: blank_to_null(F.get_json_object("metadata", f"$.{k}"))
    name = F.coalesce(m("memberName"), F.nullif(F.concat_ws(" ", m("firstName"), m("lastName")), F.lit("")), F.concat(F.lit("House PTR "), F.col("doc_id")))
    rest = {c: m(k) for k, c in STUB.items() if c not in ("doc_id", "filing_year", "filing_type", "member_name")}
    return queue.select("doc_id", F.coalesce("filing_year", F.lit(0)).alias("filing_year"), F.coalesce(F.get_json_object("metadata", "$.filingType"), F.lit("PTR")).alias("filing_type"), name.alias("member_name"),
                        *(v.alias(c) for c, v in rest.items()), F.replace(F.coalesce("source", F.lit("house-clerk")), F.lit("_"), F.lit("-")).alias("source"), F.coalesce("source_url", F.lit("")).alias("source_url"))


def trades_of(table: DataFrame) -> DataFrame:
    """Trades out of stored rows, classified anew."""
    by = {v: k for k, v in SOURCES.items()}
    t = table.withColumn("asset_description", F.coalesce(blank_to_null("asset_description"), "ticker", F.lit("Unknown asset"))).withColumn("crypto", classify("ticker", "asset_description"))
    return t.select("member_id", F.coalesce(by_value(by)[F.col("source")], F.replace("source", F.lit("_"), F.lit("-"))).alias("source"), F.when(F.col("source").startswith("senate"), "senate-trade").otherwise("house-ptr").alias("disclosure_kind"),
                    F.regexp_replace("id", r"^tr-(?:house-)?", "").alias("source_id"), F.nullif("source_url", F.lit("")).alias("source_url"), "ticker", "asset_description", "asset_type", "transaction_type", "transaction_date", "disclosure_date", "amount_min", "amount_max",
                    F.coalesce("owner", F.lit("self")).alias("owner"), "comment", F.lit(None).cast("double").alias("parser_confidence"), "crypto")


def reclassified(table: DataFrame) -> DataFrame:
    """(id, asset_type, ticker) of stored trades whose crypto kind says otherwise: what a backfill has to write.

    A ticker is only given where the row had none.
    """
    hinted = table.where(F.upper(F.concat_ws(" ", "ticker", "asset_description", "asset_type")).rlike("BITCOIN|ETHER|CRYPTO|COIN|BLOCKCHAIN") | classify("ticker", "asset_description")["kind"].isin("direct_crypto", "crypto_etf", "crypto_equity"))
    t = hinted.withColumn("c", classify("ticker", "asset_description")).where("c.kind <> 'unrelated'")
    t = t.select("id", asset_type(F.col("c.kind"), F.col("asset_type")).alias("asset_type"), F.coalesce(F.nullif(F.col("ticker"), F.lit("")), F.col("c.symbol")).alias("ticker"), F.col("asset_type").alias("was"), F.col("ticker").alias("had"))
    return t.where(~F.col("asset_type").eqNullSafe(F.col("was")) | ~F.col("ticker").eqNullSafe(F.col("had"))).select("id", "asset_type", "ticker")



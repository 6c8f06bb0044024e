"""Search documents out of records: one declarative specification a kind, compiled to one select."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null


@dataclass
class Spec:
    """What a kind of document is made of; values are columns or SQL expressions."""

    kind: str
    category: str
    key: str
    title: str
    lines: list[tuple[str, str]] = field(default_factory=list)  # label (may be empty), value
    tags: list[str] = field(default_factory=list)
    ids: dict[str, str] = field(default_factory=dict)  # name of an array column -> element
    metadata: dict[str, str] = field(default_factory=dict)
    keep_empty_tags: bool = False


def build(rows: DataFrame, spec: Spec) -> DataFrame:
    """(id, source_document_id, title, source, category, content, tags, ..., metadata): a record for each row.

    Lines without a value go; tags are distinct in order.
    """
    e = F.expr
    text = lambda x: blank_to_null(e(x).cast("string"))
    line = lambda label, x: F.concat(F.lit(f"{label}: " if label else ""), text(x))
    tags: Column = F.array(*(F.coalesce(e(x).cast("string"), F.lit("")) if spec.keep_empty_tags else text(x) for x in spec.tags)) if spec.tags else F.array().cast("array<string>")
    meta = F.to_json(F.struct(*(e(x).alias(k) for k, x in spec.metadata.items()))) if spec.metadata else F.lit("{}")
    source_id = F.concat(F.lit(f"{spec.kind}:"), e(spec.key).cast("string"))
    return rows.select(F.concat(F.lit("doc-"), source_id).alias("id"), source_id.alias("source_document_id"), text(spec.title).alias("title"), F.lit(spec.kind).alias("source"), F.lit(spec.category).alias("category"),
                       F.concat_ws("\n", *(line(a, b) for a, b in spec.lines)).alias("content"), F.array_distinct(F.array_compact(tags)).alias("tags"),
                       *(F.array_compact(F.array(text(x))).alias(k) for k, x in spec.ids.items()), meta.alias("metadata"))


def _m(low: str, high: str) -> str:
    return f"concat('$', format_number({low}, 0), ' - $', format_number({high}, 0))"


#: The kinds of documents, over the columns of the normalised records.
SPECS = {s.kind: s for s in [
    Spec("house-ptr", "disclosure", "doc_id", "concat('House PTR ', doc_id, ' - ', coalesce(member_name, 'Unknown'))", [("Member", "member_name"), ("State", "state"), ("Filed", "filing_date"), ("Source", "source_url"), ("", "trade_lines")], ["'house-ptr'", "state"], {"member_ids": "member_id"}, {"parser_confidence": "parser_confidence"}),
    Spec("senate-trade", "disclosure", "id", "concat(member_name, ' ', transaction_type, ' ', coalesce(ticker, asset_description))", [("Member", "member_name"), ("Asset", "asset_description"), ("Ticker", "ticker"), ("Amount", _m("amount_min", "amount_max")), ("Traded", "transaction_date"), ("Disclosed", "disclosure_date"), ("Comment", "comment")], ["'senate'", "ticker", "owner"], {"member_ids": "member_id", "asset_tickers": "ticker"}, {"owner": "owner"}),
    Spec("offshore-match", "offshore", "match_key", "concat(member_name, ' - ', node_name)", [("Member", "member_name"), ("Record", "node_name"), ("Type", "node_type"), ("Data", "source_dataset"), ("", "content")], ["'offshore'", "node_type", "source_dataset"], {"member_ids": "member_id"}, {"match_type": "match_type"}),
    Spec("fara-registrant", "fara", "registration_number", "concat('FARA ', name)", [("Registrant", "name"), ("Address", "address"), ("Registered", "registered"), ("", "principal_lines"), ("", "document_lines")], ["'fara'", "status"], {}, {"status": "status"}),
    Spec("fara-match", "fara", "match_key", "concat(member_name, ' - ', entity_name)", [("Member", "member_name"), ("Entity", "entity_name"), ("Kind", "entity_kind")], ["'fara'", "entity_kind"], {"member_ids": "member_id"}),
    Spec("news", "editorial", "slug", "title", [("", "summary"), ("", "body"), ("Published", "published_at")], ["'news'", "section"], {"member_ids": "member_id"}),
    Spec("dossier", "editorial", "slug", "title", [("", "summary"), ("", "finding_lines")], ["'dossier'", "topic"], {"member_ids": "member_id"}),
    Spec("member", "profile", "id", "name", [("Name", "name"), ("Party", "party"), ("State", "state"), ("Chamber", "chamber"), ("", "committee_lines"), ("Top tickers", "tickers")], ["'member'", "party", "state"], {"member_ids": "id"}, {}, True),
    Spec("committee", "profile", "id", "name", [("Committee", "name"), ("Chamber", "chamber"), ("", "member_lines")], ["'committee'", "chamber"], {"committee_ids": "id"}, {}, True),
    Spec("bill", "legislation", "id", "concat(number, ': ', title)", [("Bill", "number"), ("Title", "title"), ("Sponsor", "sponsor_name"), ("Status", "status"), ("Introduced", "introduced_date")], ["'bill'", "policy_area"], {"bill_ids": "id", "member_ids": "sponsor_id"}, {"congress": "congress"}, True),
    Spec("alert", "alert", "id", "title", [("", "description"), ("Member", "member_name"), ("Tickers", "tickers"), ("Bills", "bills")], ["'alert'", "severity"], {"member_ids": "member_id"}, {}, True),
    Spec("bill-context", "legislation", "id", "concat('Context of ', number)", [("", "summary"), ("Subjects", "subjects"), ("", "action_lines")], ["'bill-context'", "policy_area"], {"bill_ids": "id"}, {}, True),
    Spec("usaspending-match", "contracts", "match_key", "concat(company_name, ' - ', recipient_name)", [("Company", "company_name"), ("Recipient", "recipient_name"), ("Total", "concat('$', format_number(amount, 0))"), ("", "award_lines")], ["'usaspending'", "ticker"], {"asset_tickers": "ticker"}, {"score": "score"}, True),
    Spec("ptr-stub", "disclosure", "doc_id", "concat('House PTR ', doc_id)", [("Member", "member_name"), ("Filed", "filing_date"), ("Status", "status")], ["'house-ptr'", "status"], {}, {"status": "status"}),
]}

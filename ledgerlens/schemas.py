"""Stored tables: their columns, made where they are missing; a vector's length is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .operators.store import Table

_WHEN = "created_at timestamp, updated_at timestamp"
_PLACE = "address_1 string, address_2 string, city string, state string, zip_code string"
_MATCH = "match_key string, member_id string, member_name string, member_slug string"
TABLES = {
    "search_documents": f"id string, source_document_id string, title string, content string, source string, category string, document_date string, summary string, source_url string, pdf_url string, member_ids array<string>, committee_ids array<string>, bill_ids array<string>, asset_tickers array<string>, tags array<string>, metadata string, {_WHEN}",
    "search_chunks": "id string, document_id string, chunk_index int, content string, token_estimate long, title string, source string, category string, document_date string, member_ids array<string>, committee_ids array<string>, bill_ids array<string>, asset_tickers array<string>, embedding array<float>",
    "house_filing_stubs": "doc_id string, filing_year int, source string, source_url string, status string, extracted_trade_id string, metadata string, detected_at timestamp, last_seen_at timestamp",
    "trades": f"id string, member_id string, ticker string, asset_description string, asset_type string, transaction_type string, transaction_date string, disclosure_date string, amount_min long, amount_max long, owner string, comment string, source string, source_url string, conflict_score double, conflict_flags array<string>, {_WHEN}",
    "offshore_nodes": f"node_key string, node_id string, node_type string, name string, normalized_name string, source_dataset string, summary string, content string, countries array<string>, country_codes array<string>, jurisdiction string, jurisdiction_description string, company_type string, address string, status string, service_provider string, note string, valid_until string, metadata string, {_WHEN}",
    "offshore_relationships": f"relationship_key string, start_node_id string, end_node_id string, rel_type string, link string, status string, start_date string, end_date string, source_dataset string, metadata string, {_WHEN}",
    "offshore_matches": f"{_MATCH}, node_key string, node_type string, source_dataset string, match_type string, match_value string, metadata string, {_WHEN}",
    "fara_registrants": f"registration_number int, name string, normalized_name string, registration_date string, {_PLACE}, summary string, content string, metadata string, {_WHEN}",
    "fara_foreign_principals": f"principal_key string, registration_number int, foreign_principal_name string, normalized_name string, registrant_name string, country_name string, registration_date string, foreign_principal_registration_date string, {_PLACE}, metadata string, {_WHEN}",
    "fara_short_forms": f"short_form_key string, registration_number int, registrant_name string, first_name string, last_name string, full_name string, normalized_name string, short_form_date string, registration_date string, {_PLACE}, metadata string, {_WHEN}",
    "fara_documents": f"document_key string, registration_number int, registrant_name string, document_type string, date_stamped string, url string, short_form_name string, foreign_principal_name string, foreign_principal_country string, metadata string, {_WHEN}",
    "fara_matches": f"{_MATCH}, registration_number int, entity_kind string, entity_key string, registrant_name string, match_type string, match_value string, {_WHEN}",
    "usaspending_recipients": f"recipient_id string, name string, normalized_name string, query_name string, recipient_code string, uei string, total_amount double, total_outlays double, source_url string, summary string, content string, metadata string, {_WHEN}",
    "usaspending_company_matches": f"match_key string, company_id string, company_name string, ticker string, query_name string, canonical_recipient_id string, recipient_name string, normalized_recipient_name string, recipient_code string, uei string, match_type string, match_value string, total_amount double, award_count long, top_agencies array<string>, source_url string, summary string, content string, metadata string, {_WHEN}",
    "usaspending_awards": f"award_key string, match_key string, canonical_recipient_id string, recipient_name string, award_id string, internal_id long, generated_internal_id string, action_date string, award_amount double, award_type string, awarding_agency string, awarding_agency_id long, description string, source_url string, metadata string, {_WHEN}",
    "usaspending_company_syncs": f"company_id string, status string, synced_at timestamp, {_WHEN}",
    "congress_bills": f"bill_key string, site_bill_id string, congress int, bill_type string, bill_number string, title string, summary string, content string, committee_names array<string>, subjects array<string>, metadata string, {_WHEN}",
    "congress_bill_summaries": f"summary_key string, bill_key string, version_code string, action_date string, action_desc string, update_date string, text string, {_WHEN}",
    "congress_bill_actions": f"action_key string, bill_key string, action_date string, action_time string, action_code string, action_type string, text string, {_WHEN}",
    "congress_bill_syncs": f"bill_id string, last_status string, synced_at timestamp, {_WHEN}",
}

#: Of the status row: a counter's table and which of its rows count.
COUNTERS = {"offshore_nodes": ("offshore_nodes", None), "offshore_relationships": ("offshore_relationships", None), "offshore_matches": ("offshore_matches", None), "fara_registrants": ("fara_registrants", None), "fara_foreign_principals": ("fara_foreign_principals", None),
            "fara_short_forms": ("fara_short_forms", None), "fara_documents": ("fara_documents", None), "fara_matches": ("fara_matches", None), "usaspending_recipients": ("usaspending_recipients", None), "usaspending_company_matches": ("usaspending_company_matches", None), "usaspending_awards": ("usaspending_awards", None),
            "usaspending_matched_syncs": ("usaspending_company_syncs", "status = 'matched'"), "congress_bills": ("congress_bills", None), "congress_summaries": ("congress_bill_summaries", None), "congress_actions": ("congress_bill_actions", None), "congress_synced_bills": ("congress_bill_syncs", "last_status = 'ok'"),
            "search_documents": ("search_documents", None), "search_chunks": ("search_chunks", None), "embedded_chunks": ("search_chunks", "embedding is not null")}


class Store:
    """All stored tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.folder}/{name}")

    def ensure(self, *names: str) -> list[str]:
        """Makes the tables that are missing, empty; which these were."""
        made = [n for n in names or TABLES if self.table(n).read() is None]
        for n in made:
            self.table(n).write(self.spark.createDataFrame([], TABLES[n]))
        return made

    def read(self, name: str) -> DataFrame:
        return self.table(name).read() or self.spark.createDataFrame([], TABLES[name])

    def write(self, name: str, df: DataFrame) -> None:
        """The next version, in the table's columns: missing ones are null."""
        have = set(df.columns)
        self.table(name).write(df.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(TABLES[name]))))

    def status(self) -> DataFrame:
        """One row of counters, each table read once."""
        by_table: dict[str, list] = {}
        for name, (table, where) in COUNTERS.items():
            by_table.setdefault(table, []).append((F.count_if(F.expr(where)) if where else F.count("*")).alias(name))
        out = None
        for table, counts in by_table.items():
            one = self.read(table).agg(*counts)
            out = one if out is None else out.join(F.broadcast(one))
        return out.select(*COUNTERS)


def check_vectors(chunks: DataFrame, dim: int) -> None:
    """An error if stored vectors are of another length than the embedder's."""
    other = chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") != dim)).select(F.size("embedding")).first()
    if other is not None:
        raise ValueError(f"stored vectors have {other[0]} numbers, the embedder gives {dim}")

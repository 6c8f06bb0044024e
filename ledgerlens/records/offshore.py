"""Offshore leaks: nodes and links of the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sha1_key
from ..functions.text import normalize_name, split_multi, strip_ws
from .base import joined, lines, pick, raw

DEFAULT = "Offshore Leaks"
_TOLD = ("name", "original_name", "former_name", "jurisdiction_description", "company_type", "address", "countries", "sourceID", "service_provider", "note")
_KEPT = ("jurisdiction", "jurisdiction_description", "company_type", "address", "status", "service_provider", "note", "valid_until")


def nodes(rows: DataFrame) -> DataFrame:
    """Records of (node_type, row); rows without a node id are left out."""
    r, kind, filled = F.col("row"), F.col("node_type"), lambda k: F.nullif(F.col("row")[k], F.lit(""))
    node = pick(r, "node_id")
    name = F.coalesce(pick(r, "name", "original_name", "address"), F.concat(F.lit("Offshore node "), node))
    data = F.coalesce(filled("sourceID"), F.lit(DEFAULT))
    known = lines(data, joined(split_multi(r["countries"])), F.coalesce(filled("jurisdiction_description"), filled("jurisdiction")), filled("company_type"), by=" | ")
    base = F.coalesce(filled("name"), filled("original_name"), filled("address"), filled("node_id"), F.lit("Unnamed node"))
    role = F.when(kind == "officer", "Officer or beneficial owner record").when(kind == "intermediary", "Intermediary or service-provider record")
    return rows.where(node.isNotNull()).select(
        F.concat_ws(":", kind, node).alias("node_key"), node.alias("node_id"), kind.alias("node_type"), name.alias("name"), normalize_name(name).alias("normalized_name"), strip_ws(data).alias("source_dataset"), F.concat_ws(" | ", base, known).alias("summary"),
        lines(*(strip_ws(r[k]) for k in _TOLD), role).alias("content"), split_multi(r["countries"]).alias("countries"), split_multi(r["country_codes"]).alias("country_codes"), *(pick(r, k).alias(k) for k in _KEPT), raw(r).alias("metadata"))


def links(rows: DataFrame) -> DataFrame:
    r = F.col("row")
    start, end, kind, link = (F.coalesce(pick(r, k), F.lit("")) for k in ("node_id_start", "node_id_end", "rel_type", "link"))
    data = strip_ws(F.coalesce(F.nullif(r["sourceID"], F.lit("")), F.lit(DEFAULT)))
    return rows.select(sha1_key(start, end, kind, link, data).alias("relationship_key"), start.alias("start_node_id"), end.alias("end_node_id"), kind.alias("rel_type"), *(pick(r, k).alias(k) for k in ("link", "status", "start_date", "end_date")), data.alias("source_dataset"), raw(r).alias("metadata"))

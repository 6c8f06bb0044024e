"""Members found in other registers by their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sha1_key
from ..operators.relational import pick_per_key
from ..operators.resolve import resolve
from .base import same_person


def _found(rows: DataFrame, members: DataFrame, name: str, state: str | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows whose name leads to one member, with the member's id, name and slug."""
    take = {"name": name, "state": state, "first": first, "last": last}
    rows = rows.withColumn("_row", same_person(*(c for c in take.values() if c)))
    keyed = rows.select(F.col("_row").alias("row_id"), *(F.col(c).alias(k) for k, c in take.items() if c)).distinct()
    who = resolve(keyed, members, state="state" if state else None, first="first" if first else None, last="last" if last else None).where("member_id is not null")
    m = members.select(F.col("id").alias("member_id"), F.col("name").alias("member_name"), F.col("slug").alias("member_slug"))
    return rows.join(who.select(F.col("row_id").alias("_row"), "member_id", "matched_kind"), "_row").join(m, "member_id").drop("_row")


def offshore(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """Matches of nodes' names, each once by its key."""
    n = _found(nodes, members, "name")
    meta = F.to_json(F.struct(F.col("normalized_name").alias("normalizedName"), "countries", F.col("country_codes").alias("countryCodes"), F.coalesce("jurisdiction_description", "jurisdiction").alias("jurisdiction")), {"ignoreNullFields": "false"})
    got = n.select(sha1_key("member_id", "node_key", F.lit("exact_name")).alias("match_key"), F.col("member_id").cast("string").alias("member_id"), "member_name", "member_slug", "node_key", "node_type", "source_dataset", F.lit("exact_name").alias("match_type"), F.col("name").alias("match_value"), meta.alias("metadata"), "matched_kind")
    return pick_per_key(got, ["match_key"], F.desc("match_value"))


def fara(registrants: DataFrame, principals: DataFrame, short_forms: DataFrame, members: DataFrame) -> DataFrame:
    """Matches of registrants and principals (with their state) and of short forms' people, each once by its key."""
    names = registrants.select("registration_number", F.col("name").alias("registrant"))

    def kind(rows: DataFrame, what: str, key: Column, value: str, **how) -> DataFrame:
        n = _found(rows, members, value, **how).join(names, "registration_number")
        return n.select(sha1_key("member_id", F.lit(what), key, value, F.lit("exact_name")).alias("match_key"), F.col("member_id").cast("string").alias("member_id"), "member_name", "member_slug", "registration_number", F.lit(what).alias("entity_kind"), key.cast("string").alias("entity_key"),
                        F.col("registrant").alias("registrant_name"), F.lit("exact_name").alias("match_type"), F.col(value).alias("match_value"), "matched_kind")
    got = (kind(registrants, "registrant", F.col("registration_number").cast("string"), "name", state="state")
           .unionByName(kind(principals, "foreign_principal", F.col("principal_key"), "foreign_principal_name", state="state"))
           .unionByName(kind(short_forms, "short_form", F.col("short_form_key"), "full_name", state="state", first="first_name", last="last_name")))
    return pick_per_key(got, ["match_key"], F.desc("match_value"))

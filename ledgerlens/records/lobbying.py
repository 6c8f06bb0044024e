"""Lobbying disclosures: quarterly filings and contribution reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTY = "struct<id:string,name:string>"
FILING = (f"filing_uuid string, filing_type string, filing_type_display string, filing_period string, filing_period_display string, filing_year int, income string, expenses string, dt_posted string, registrant {_PARTY}, client {_PARTY}, "
          "lobbying_activities array<struct<general_issue_code:string,description:string,lobbyists:array<struct<first_name:string,last_name:string>>,government_entities:array<struct<name:string>>>>")
CONTRIBUTION = (f"filing_uuid string, no_contributions boolean, filing_year int, filing_period_display string, dt_posted string, registrant {_PARTY}, lobbyist struct<first_name:string,last_name:string>, "
                "contribution_items array<struct<amount:string,recipient_name:string,contribution_type:string,contribution_type_display:string,date:string>>, pacs array<string>")


def _or_empty(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(""))


def _day() -> Column:
    return F.nullif(F.substring("dt_posted", 1, 10), F.lit(""))


def _set(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(x, lambda v: F.coalesce(v, F.lit("")) != "")))


def filings(rows: DataFrame) -> DataFrame:
    """Records of rows in the columns of ``FILING``; sets come sorted.  Without a uuid the id is a hash of the row."""
    none = F.array().cast("array<string>")
    each = lambda f: F.coalesce(F.transform("lobbying_activities", f), none)
    many = lambda f: F.coalesce(F.flatten(F.filter(F.transform("lobbying_activities", f), lambda v: v.isNotNull())), none)
    people = many(lambda a: F.transform(a["lobbyists"], lambda p: F.trim(F.concat(F.coalesce(p["first_name"], F.lit("")), F.lit(" "), F.coalesce(p["last_name"], F.lit(""))))))
    amount = F.coalesce(F.nullif(F.col("income").try_cast("double"), F.lit(0.0)), F.col("expenses").try_cast("double"), F.lit(0.0))
    own = F.when(_or_empty("filing_uuid") != "", F.substring("filing_uuid", 1, 36)).otherwise(F.substring(F.md5(F.to_json(F.struct(*rows.columns))), 1, 24))
    period = F.when(F.coalesce("filing_year", F.lit(0)) != 0, F.concat_ws("_", "filing_year", _or_empty("filing_period"))).otherwise(F.coalesce("filing_period_display", "filing_period", F.lit("")))
    return rows.select(F.concat(F.lit("lda-"), own).alias("id"), *(_or_empty(f"{a}.{b}").alias(f"{a}_{b}") for a in ("registrant", "client") for b in ("name", "id")), F.lit(None).cast("string").alias("company_id"), amount.cast("long").alias("amount"), _set(each(lambda a: a["general_issue_code"])).alias("issue_codes"),
                       F.slice(F.filter(each(lambda a: a["description"]), lambda v: F.coalesce(v, F.lit("")) != ""), 1, 10).alias("specific_bills"), _set(people).alias("lobbyists"), period.alias("filing_period"), _day().alias("filing_date"), F.coalesce("filing_type_display", "filing_type", F.lit("")).alias("filing_type"),
                       _set(many(lambda a: F.transform(a["government_entities"], lambda e: e["name"]))).alias("gov_entities"))


def contributions(rows: DataFrame) -> DataFrame:
    """Records of rows in the columns of ``CONTRIBUTION``; reports without contributions go.  Committees are texts or objects."""
    item = "array<struct<amount:string,recipient_name:string,contribution_type:string,date:string>>"
    made = F.transform("contribution_items", lambda i: F.struct(i["amount"].alias("amount"), F.coalesce(i["recipient_name"], F.lit("")).alias("recipient_name"), F.coalesce(i["contribution_type_display"], i["contribution_type"], F.lit("")).alias("contribution_type"), i["date"].alias("date")))

    def committee(p: Column) -> Column:
        whole = p.startswith("{")
        return F.struct(F.when(whole, F.get_json_object(p, "$.amount")).alias("amount"), F.when(whole, F.coalesce(F.get_json_object(p, "$.name"), F.lit(""))).otherwise(F.trim(p)).alias("recipient_name"), F.lit("PAC").alias("contribution_type"), F.lit(None).cast("string").alias("date"))
    pacs = F.transform(F.filter("pacs", lambda p: F.coalesce(F.trim(p), F.lit("")) != ""), committee)
    items = F.concat(F.coalesce(made.cast(item), F.array().cast(item)), F.coalesce(pacs.cast(item), F.array().cast(item)))
    got = rows.where(~F.coalesce("no_contributions", F.lit(False))).select(
        F.concat(F.lit("lda-contrib-"), F.substring(_or_empty("filing_uuid"), 1, 36)).alias("id"), _or_empty("registrant.name").alias("registrant_name"), _or_empty("registrant.id").alias("registrant_id"), F.trim(F.concat_ws(" ", F.nullif("lobbyist.first_name", F.lit("")), F.nullif("lobbyist.last_name", F.lit("")))).alias("lobbyist_name"),
        "filing_year", _or_empty("filing_period_display").alias("filing_period"), _day().alias("filing_date"), items.alias("contribution_items"))
    return got.where(F.size("contribution_items") > 0)

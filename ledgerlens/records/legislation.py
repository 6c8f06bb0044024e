"""Bills with their summaries and actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import date_of
from ..functions.hashing import sha1_key
from ..functions.text import blank_to_null, html_to_text
from .base import joined, labelled, lines, texts

_COUNT = "struct<count:int>"
BILL = f"congress int, type string, number string, title string, originChamber string, policyArea struct<name:string>, sponsors array<struct<bioguideId:string,fullName:string,party:string,state:string,district:string>>, introducedDate string, latestAction struct<actionDate:string,text:string>, updateDate string, updateDateIncludingText string, legislationUrl string, constitutionalAuthorityStatementText string, committees {_COUNT}, cosponsors {_COUNT}, subjects {_COUNT}, textVersions {_COUNT}"
SUMMARY = "versionCode string, actionDate string, actionDesc string, updateDate string, text string"
ACTION = "actionDate string, actionTime string, actionCode string, type string, text string, committees array<struct<name:string,systemCode:string>>, sourceSystem struct<code:int,name:string>"


def bill_key(congress: Column, kind: Column, number: Column) -> Column:
    return F.concat_ws("-", congress.cast("int"), F.lower(F.trim(kind)), F.trim(number))


def summaries(items: DataFrame) -> DataFrame:
    """Records of (bill_key, SUMMARY...), those without a text left out; ``rank`` is 1 for a bill's latest."""
    text, day = html_to_text("text"), date_of("actionDate")
    s = items.select("bill_key", blank_to_null("versionCode").alias("version_code"), day.alias("action_date"), blank_to_null("actionDesc").alias("action_desc"), blank_to_null("updateDate").alias("update_date"), text.alias("text")).where("text <> ''")
    s = s.select(sha1_key("bill_key", "version_code", "action_date", "update_date", F.substring("text", 1, 120)).alias("summary_key"), "*")
    return _ranked(s, "action_date", "update_date", "version_code", key="summary_key")


def actions(items: DataFrame) -> DataFrame:
    """Records of (bill_key, ACTION...), those without a text left out; ``rank`` is 1 for a bill's latest."""
    text = html_to_text("text")
    named = lambda f: texts(F.transform(F.col("committees"), lambda c: c[f]))
    a = items.select("bill_key", date_of("actionDate").alias("action_date"), blank_to_null("actionTime").alias("action_time"), blank_to_null("actionCode").alias("action_code"), blank_to_null("type").alias("action_type"), text.alias("text"),
                     blank_to_null("sourceSystem.name").alias("source_system_name"), F.col("sourceSystem.code").alias("source_system_code"), named("name").alias("committee_names"), named("systemCode").alias("committee_codes")).where("text <> ''")
    a = a.select(sha1_key("bill_key", "action_date", "action_time", "action_code", F.substring("text", 1, 160)).alias("action_key"), "*")
    return _ranked(a, "action_date", "action_time", key="action_key")


def _ranked(df: DataFrame, *by: str, key: str) -> DataFrame:
    """The latest first: missing parts count as empty texts; ties by key."""
    order = [F.desc(F.coalesce(c, F.lit(""))) for c in by]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("bill_key").orderBy(*order, F.asc(key))))


def _distinct_in_order(lists: Column) -> Column:
    """Distinct entries of the lists of an ordered list."""
    return F.array_distinct(F.flatten(F.transform(F.array_sort(lists), lambda x: x["v"])))


def bills(site: DataFrame, official: DataFrame, summary: DataFrame, action: DataFrame) -> DataFrame:
    """One record a bill of ``site`` (id, congress, bill_type, number, title, short_title, subjects, introduced_date).

    ``official`` has the columns of ``BILL`` and the site's id as site_bill_id; what it lacks comes from the site.
    """
    s = site.select(F.col("id").cast("string").alias("site_bill_id"), *(F.col(c).alias(f"_{c}") for c in ("congress", "bill_type", "number", "title", "short_title", "subjects", "introduced_date")))
    b = s.join(official.withColumnRenamed("subjects", "subjectsInfo"), "site_bill_id", "left")
    congress = F.coalesce(F.when(F.col("congress") != 0, F.col("congress")), F.col("_congress").cast("int"), F.lit(0))
    kind, number = F.lower(F.trim(F.coalesce(F.nullif("type", F.lit("")), "_bill_type", F.lit("")))), F.trim(F.coalesce(F.nullif("number", F.lit("")), F.col("_number").cast("string"), F.lit("")))
    b = b.withColumn("bill_key", bill_key(congress, kind, number))
    newest = summary.where("rank = 1").select("bill_key", F.col("text").alias("_summary"))
    counts = summary.groupBy("bill_key").agg(F.count("*").cast("int").alias("_summaries"))
    acts = action.groupBy("bill_key").agg(F.count("*").cast("int").alias("_actions"), F.min_by("text", "rank").alias("_action"), _distinct_in_order(F.collect_list(F.struct("rank", F.col("committee_names").alias("v")))).alias("_committees"), _distinct_in_order(F.collect_list(F.struct("rank", F.col("committee_codes").alias("v")))).alias("_codes"))
    b = b.join(newest, "bill_key", "left").join(counts, "bill_key", "left").join(acts, "bill_key", "left")
    none = F.array().cast("array<string>")
    b = b.withColumns({"_committees": F.coalesce("_committees", none), "_codes": F.coalesce("_codes", none), "_subjects": texts(F.col("_subjects")), "_sponsor": F.get("sponsors", F.lit(0))})
    t = blank_to_null
    content = lines(F.col("_summary"), F.col("_action"), F.when(F.col("policyArea").isNotNull(), F.concat(F.lit("Policy area: "), F.coalesce("policyArea.name", F.lit("None")))), labelled("Committees", joined(F.col("_committees"))), labelled("Subjects", joined(F.col("_subjects"))), by="\n\n")
    api = F.when((congress != 0) & (kind != "") & (number != ""), F.concat(F.lit("https://api.congress.gov/v3/bill/"), congress, F.lit("/"), kind, F.lit("/"), number, F.lit("?format=json")))
    meta = F.to_json(F.struct("latestAction", F.nullif(html_to_text("constitutionalAuthorityStatementText"), F.lit("")).alias("constitutionalAuthorityStatementText"), "sponsors"))
    zero = lambda x, y: F.coalesce(F.when(x != 0, x), y)
    return b.select(
        "bill_key", "site_bill_id", congress.alias("congress"), kind.alias("bill_type"), number.alias("bill_number"), F.coalesce(t("title"), t("_title"), F.lit("")).alias("title"), t("_short_title").alias("short_title"), t("originChamber").alias("origin_chamber"), t("policyArea.name").alias("policy_area"),
        *(t(f"_sponsor.{a}").alias(f"sponsor_{c}") for a, c in (("bioguideId", "bioguide_id"), ("fullName", "full_name"), ("party", "party"), ("state", "state"), ("district", "district"))),
        date_of(F.coalesce(F.nullif("introducedDate", F.lit("")), F.col("_introduced_date").cast("string"))).alias("introduced_date"), date_of("latestAction.actionDate").alias("latest_action_date"), t("latestAction.text").alias("latest_action_text"), t("updateDate").alias("update_date"), t("updateDateIncludingText").alias("update_date_including_text"),
        t("legislationUrl").alias("legislation_url"), api.alias("api_url"), F.coalesce("_summaries", F.lit(0)).alias("summaries_count"), F.coalesce("_actions", F.lit(0)).alias("actions_count"), zero(F.col("committees.count"), F.size("_committees")).alias("committees_count"), F.coalesce("cosponsors.count", F.lit(0)).alias("cosponsors_count"),
        zero(F.col("subjectsInfo.count"), F.size("_subjects")).alias("subject_count"), F.coalesce("textVersions.count", F.lit(0)).alias("text_version_count"), F.col("_summary").alias("summary"), content.alias("content"), F.col("_committees").alias("committee_names"), F.col("_codes").alias("committee_codes"), F.col("_subjects").alias("subjects"), meta.alias("metadata"))

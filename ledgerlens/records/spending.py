"""Federal spending: recipients, matches with companies, awards and agencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import sha1_key
from ..functions.money import to_double, to_long
from ..functions.text import blank_to_null, normalize_name
from ..operators.relational import pick_per_key
from .base import labelled, lines, money, pick, raw, texts

RECIPIENT = "recipient_id string, name string, code string, uei string, amount double, total_outlays double, totalTransactions long"
AGENCY = "id string, name string, code string, amount double"


def url(recipient: Column) -> Column:
    return F.concat(F.lit("https://www.usaspending.gov/recipient/"), recipient, F.lit("/latest"))


def awards_of(rows: DataFrame, recipient: Column, limit: int) -> DataFrame:
    """Of downloaded award summaries (row) those of a recipient by normalised name: each award once, the largest first."""
    r = F.col("row")
    key = pick(r, "contract_award_unique_key", "award_id_piid", "award_id_fain")
    mine = rows.where((normalize_name(pick(r, "recipient_name")) == normalize_name(recipient)) & key.isNotNull()).withColumn("generated_internal_id", key)
    mine = pick_per_key(mine, ["generated_internal_id"], F.asc("file"), F.asc("entry"), F.asc("line"))
    named = {"award_id": F.coalesce(pick(r, "award_id_piid", "award_id_fain"), F.col("generated_internal_id")), "recipient_name": pick(r, "recipient_name"), "action_date": pick(r, "award_latest_action_date", "award_base_action_date"),
             "award_amount": F.coalesce(r["current_total_value_of_award"].try_cast("double"), r["total_obligated_amount"].try_cast("double")), "awarding_agency": pick(r, "awarding_agency_name"), "award_type": pick(r, "award_type", "award_type_code"),
             "description": pick(r, "prime_award_base_transaction_description"), "awarding_agency_id": pick(r, "awarding_agency_code")}
    got = mine.select("generated_internal_id", *(v.alias(k) for k, v in named.items()), raw(r).alias("metadata"))
    return got.orderBy(F.desc(F.coalesce("award_amount", F.lit(0.0))), "generated_internal_id").limit(max(1, limit))


def agencies_of(contracts: DataFrame, vehicles: DataFrame, limit: int) -> DataFrame:
    """The agencies of two searches in one list, each once by id (or name) with its larger amount, the largest first."""
    both = contracts.unionByName(vehicles).withColumn("_key", F.coalesce(blank_to_null("id"), blank_to_null("name"), F.lit("")))
    amount = F.coalesce("amount", F.lit(0.0))
    return pick_per_key(both, ["_key"], F.desc(amount), F.asc("name")).orderBy(F.desc(amount), "_key").limit(max(1, limit)).drop("_key")


def recipients(rows: DataFrame, query: Column) -> DataFrame:
    """Records of search results in the columns of ``RECIPIENT``."""
    key = F.coalesce(blank_to_null("recipient_id"), F.lit(""))
    name = F.coalesce(blank_to_null("name"), F.concat(F.lit("Recipient "), key))
    none = lambda c: F.coalesce(blank_to_null(c), F.lit("None"))
    summary = F.when(F.col("amount").isNotNull(), F.concat(name, F.lit(" received approximately "), money(F.col("amount")), F.lit(" in tracked federal spending during the queried window."))).otherwise(F.concat(name, F.lit(" appears in USAspending recipient search results for the queried window.")))
    content = lines(F.concat(F.lit("Recipient: "), name), F.concat(F.lit("Recipient ID: "), key), labelled("UEI", none("uei")), labelled("Recipient code", none("code")), F.concat(F.lit("Queried as: "), query), labelled("Federal spending", money(F.col("amount"), 2)), labelled("Total outlays", money(F.col("total_outlays"), 2)))
    return rows.select(key.alias("recipient_id"), name.alias("name"), normalize_name(name).alias("normalized_name"), query.alias("query_name"), blank_to_null("code").alias("recipient_code"), blank_to_null("uei").alias("uei"), F.col("amount").alias("total_amount"), "total_outlays",
                       F.when(key != "", url(key)).alias("source_url"), summary.alias("summary"), content.alias("content"), F.col("totalTransactions").alias("transactions"), F.to_json(F.struct(*rows.columns)).alias("metadata"))


def most_common(names: Column, n: int = 5) -> Column:
    """The n most frequent of a list's texts; ties by where they first stand."""
    each = F.transform(F.array_distinct(names), lambda v: F.struct((-F.size(F.filter(names, lambda x: x == v))).alias("n"), F.array_position(names, v).alias("at"), v.alias("name")))
    return F.transform(F.slice(F.array_sort(each), 1, n), lambda s: s["name"])


def company_matches(companies: DataFrame, records: DataFrame, awards: DataFrame, agencies: DataFrame) -> DataFrame:
    """A match for each company (company_id, company_name, ticker, recipient_id) with its recipient's record.

    ``awards`` and ``agencies`` have a recipient_id and are taken in order of their amount.  Where there are no
    agencies, the awards' agencies count.
    """
    largest = lambda df, amount, *cols: df.groupBy("recipient_id").agg(F.array_sort(F.collect_list(F.struct((-F.coalesce(amount, F.lit(0.0))).alias("o"), *cols))).alias("held"))
    a = largest(awards, "award_amount", "award_id", "awarding_agency", "award_amount").withColumnRenamed("held", "_awards")
    g = largest(agencies, "amount", "name", "amount").withColumnRenamed("held", "_agencies")
    r = records.select("recipient_id", F.col("name").alias("recipient_name"), F.col("normalized_name").alias("normalized_recipient_name"), "query_name", "recipient_code", "uei", "total_amount", "source_url", "transactions", F.col("metadata").alias("_meta"))
    m = companies.join(r, "recipient_id").join(a, "recipient_id", "left").join(g, "recipient_id", "left")
    none = lambda c, t: F.coalesce(F.col(c), F.array().cast(t))
    m = m.withColumns({c: none(c, m.schema[c].dataType) for c in ("_awards", "_agencies")})
    named = texts(F.transform("_agencies", lambda x: x["name"]))
    m = m.withColumn("top_agencies", most_common(F.when(F.size(named) > 0, named).otherwise(texts(F.transform("_awards", lambda x: x["awarding_agency"])))))
    who = F.concat(F.col("company_name"), F.lit(" matches USAspending recipient "), F.col("recipient_name"))
    summary = F.when(F.col("total_amount").isNotNull(), F.concat(who, F.lit(", with approximately "), money(F.col("total_amount")), F.lit(" in tracked federal spending during the queried window."))).otherwise(F.concat(who, F.lit(" in federal spending records.")))
    filled = lambda x: F.coalesce(F.trim(x), F.lit(""))
    rollup = F.transform(F.filter(F.slice("_agencies", 1, 6), lambda x: (filled(x["name"]) != "") & x["amount"].isNotNull()), lambda x: F.concat(F.trim(x["name"]), F.lit(" ("), money(x["amount"]), F.lit(")")))
    top = F.transform(F.filter(F.slice("_awards", 1, 6), lambda x: (filled(x["award_id"]) != "") & x["award_amount"].isNotNull()), lambda x: F.concat(F.trim(x["award_id"]), F.lit(" ("), filled(x["awarding_agency"]), F.lit(", "), money(x["award_amount"]), F.lit(")")))
    content = lines(summary, labelled("Ticker", F.col("ticker")), labelled("Queried as", F.col("query_name")), labelled("Recipient code", F.col("recipient_code")), labelled("UEI", F.col("uei")), labelled("Top agencies", F.array_join("top_agencies", ", ")),
                    F.when(F.size("_agencies") > 0, F.concat(F.lit("Agency rollup: "), F.array_join(rollup, "; "))), F.when(F.size("_awards") > 0, F.concat(F.lit("Top awards: "), F.array_join(top, "; "))))
    meta = F.to_json(F.struct(F.col("query_name").alias("queryName"), F.parse_json("_meta").alias("recipientMetadata"), F.transform("_agencies", lambda x: F.struct(x["name"].alias("name"), x["amount"].alias("amount"))).alias("agencyRollup"), F.size("_awards").alias("awardSampleCount")))
    return m.select(sha1_key("company_id", "recipient_id").alias("match_key"), "company_id", "company_name", "ticker", "query_name", F.col("recipient_id").alias("canonical_recipient_id"), "recipient_name", "normalized_recipient_name", "recipient_code", "uei",
                    F.lit("recipient_name").alias("match_type"), F.col("recipient_name").alias("match_value"), "total_amount", F.coalesce(F.col("transactions"), F.size("_awards").cast("long")).alias("award_count"), "top_agencies", "source_url", summary.alias("summary"), content.alias("content"), meta.alias("metadata"))


def award_records(matches: DataFrame, awards: DataFrame) -> DataFrame:
    """Records of awards (recipient_id, award_id, internal_id, generated_internal_id, ...) for each match of their recipient."""
    a = awards.select(F.col("recipient_id").alias("canonical_recipient_id"), *(c for c in awards.columns if c not in ("recipient_id", "recipient_name", "source_url", "internal_id")), (F.col("internal_id") if "internal_id" in awards.columns else F.lit(None)).cast("string").alias("_internal"))
    m = a.join(matches.select("match_key", "canonical_recipient_id", "recipient_name", "source_url"), "canonical_recipient_id")
    own = F.coalesce(blank_to_null("award_id"), F.lit(""))
    key = sha1_key("match_key", own, "_internal", "generated_internal_id")
    return m.select(key.alias("award_key"), "match_key", "canonical_recipient_id", "recipient_name", F.when(own != "", own).otherwise(F.concat(F.lit("award-"), F.substring(key, 1, 12))).alias("award_id"), to_long("_internal").alias("internal_id"), "generated_internal_id", "action_date",
                    to_double(F.col("award_amount").cast("string")).alias("award_amount"), "award_type", "awarding_agency", to_long(F.col("awarding_agency_id").cast("string")).alias("awarding_agency_id"), "description", "source_url", "metadata")


def best_recipients(candidates: DataFrame, company: str = "company_id") -> DataFrame:
    """Of scored candidates the best query for each recipient of a company: by score, then amount, then as they came."""
    w = Window.partitionBy(company, "recipient_id").orderBy(F.desc("score"), F.desc(F.coalesce("amount", F.lit(0.0))), F.asc("seq"))
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


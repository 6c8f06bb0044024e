"""Search documents out of records: one builder a kind, each a single select.

``site`` is the base address of the site that the documents link to, ``name`` what its own sources, tags and ids are
called.  Lists in site rows are JSON texts or arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.dates import date_of
from ..functions.text import blank_to_null
from .base import joined, labelled, lines, money, one, tags, texts

_NONE = "array<string>"
_TRADES = ("stock-act", "congressional-trades")
_ORDER = ["id", "source_document_id", "title", "content", "source", "category", "document_date", "summary", "source_url", "pdf_url", "member_ids", "committee_ids", "bill_ids", "asset_tickers", "tags", "metadata"]


def _c(x: Column | str | None) -> Column:
    return F.col(x) if isinstance(x, str) else F.lit(None).cast("string") if x is None else x


def document(rows: DataFrame, key: Column, title: Column, content: Column, source: Column | str, category: str, *, day=None, summary=None, url=None, pdf=None, members=None, committees=None, bills=None, tickers=None, tags: Column, meta: dict[str, Column | str]) -> DataFrame:
    """Search records: what isn't given is null or an empty list; metadata is JSON with null fields kept."""
    empty = F.array().cast(_NONE)
    several = lambda x: empty if x is None else F.coalesce(x, empty)
    return rows.select(
        F.concat(F.lit("doc-"), key).alias("id"), key.alias("source_document_id"), title.alias("title"), F.coalesce(F.regexp_replace(content, r"(?U)^\s+|\s+$", ""), F.lit("")).alias("content"), (F.lit(source) if isinstance(source, str) else source).alias("source"), F.lit(category).alias("category"),
        _c(day).alias("document_date"), _c(summary).alias("summary"), _c(url).alias("source_url"), _c(pdf).alias("pdf_url"), several(members).alias("member_ids"), several(committees).alias("committee_ids"), several(bills).alias("bill_ids"), several(tickers).alias("asset_tickers"), tags.alias("tags"),
        F.to_json(F.struct(*((F.col(v) if isinstance(v, str) else v).alias(k) for k, v in meta.items())), {"ignoreNullFields": "false"}).alias("metadata")).select(*_ORDER)


def _t(name: str) -> Column:
    """A column's trimmed text, empty for null."""
    return F.coalesce(F.trim(F.col(name).cast("string")), F.lit(""))


def _n(name: str) -> Column:
    return blank_to_null(F.col(name).cast("string"))


def strings(rows: DataFrame, name: str) -> Column:
    """A column's texts: of an array, of JSON, or itself as the only one."""
    if name not in rows.columns:
        return F.array().cast(_NONE)
    if isinstance(rows.schema[name].dataType, ArrayType):
        return texts(F.col(name).cast(_NONE))
    x = blank_to_null(name)
    return F.when(x.isNull(), F.array().cast(_NONE)).when(x.startswith("["), F.coalesce(texts(F.from_json(x, _NONE)), F.array(x))).otherwise(F.array(x))


def objects(rows: DataFrame, name: str, fields: str) -> Column:
    """A column's objects: of an array of structs or of JSON; anything else is none."""
    kind = f"array<struct<{fields}>>"
    empty = F.array().cast(kind)
    if name not in rows.columns:
        return empty
    got = F.col(name) if isinstance(rows.schema[name].dataType, ArrayType) else F.from_json(name, kind)
    return F.filter(F.coalesce(got, empty), lambda x: x.isNotNull())


def _field(xs: Column, field: str) -> Column:
    return texts(F.transform(xs, lambda x: x[field]))


def house_report(stubs: DataFrame, results: DataFrame, trades: DataFrame) -> DataFrame:
    """Of parsed reports: stubs with their result (doc_id, parser_confidence, raw_text_preview, n) and their trades."""
    held = trades.where("disclosure_kind = 'house-ptr' and ticker <> ''").groupBy(F.substring_index("source_id", ":", 1).alias("doc_id")).agg(F.array_sort(F.collect_set("ticker")).alias("_tickers"))
    r = stubs.join(results.select("doc_id", "parser_confidence", "raw_text_preview", F.col("n").alias("_n")), "doc_id").join(held, "doc_id", "left")
    summary = F.concat(F.lit("House PTR filed by "), F.col("member_name"), F.when(F.col("_n") > 0, F.concat(F.lit(" with "), F.col("_n"), F.lit(" parsed transactions."))).otherwise(F.lit(" awaiting manual review.")))
    linked = F.when(F.size("_tickers") > 0, F.array(F.lit("ticker-linked"))).otherwise(F.array().cast(_NONE))
    return document(r, F.concat(F.lit("house-ptr-"), "doc_id"), F.concat_ws(" ", "member_name", F.lit("House PTR"), "doc_id"), F.col("raw_text_preview"), "house-clerk", "stock-act", day="filing_date", summary=summary, url="source_url", pdf="source_url", members=one(F.col("member_id")), tickers=F.col("_tickers"),
                    tags=tags("house-ptr", *_TRADES, linked), meta={"docId": "doc_id", "filingYear": "filing_year", "filingType": "filing_type", "parserConfidence": "parser_confidence", "parsedTransactionCount": "_n"})


def house_stub(queue: DataFrame) -> DataFrame:
    """Of stored queue rows (doc_id, filing_year, source_url, status, metadata)."""
    m = lambda k: blank_to_null(F.get_json_object("metadata", f"$.{k}"))
    own = F.concat(F.lit("House PTR "), F.col("doc_id"))
    q = queue.withColumns({"_name": F.coalesce(m("memberName"), own), "_text": F.coalesce(m("rawTextPreview"), F.lit("")), "_trades": F.coalesce(F.from_json(F.get_json_object("metadata", "$.parsedTransactions"), "array<struct<ticker:string>>"), F.array().cast("array<struct<ticker:string>>")), "_status": F.coalesce("status", F.lit("parsed"))})
    n = F.size("_trades")
    tickers = F.array_sort(F.array_distinct(F.transform(_field(F.col("_trades"), "ticker"), F.upper)))
    summary = F.concat(F.lit("House PTR filed by "), F.col("_name"), F.when(n > 0, F.concat(F.lit(" with "), n, F.lit(" parsed transactions."))).otherwise(F.lit(" awaiting deeper review.")))
    return document(q, F.concat(F.lit("house-ptr-"), "doc_id"), F.concat_ws(" ", "_name", own), F.col("_text"), "house-clerk", "stock-act", day=m("filingDate"), summary=summary, url=_n("source_url"), pdf=_n("source_url"), members=one(m("memberId")), tickers=tickers, tags=tags("house-ptr", *_TRADES),
                    meta={"docId": "doc_id", "filingYear": "filing_year", "filingType": F.coalesce(m("filingType"), F.lit("PTR")), "parserConfidence": m("parserConfidence").try_cast("double"), "parsedTransactionCount": n, "stubStatus": "_status"})


def senate_trade(trades: DataFrame, members: DataFrame) -> DataFrame:
    """Of Senate trades with their members (id, name, slug, party, state)."""
    m = members.select(F.col("id").cast("string").alias("member_id"), F.col("name").alias("member_name"), "slug", "party", F.col("state").alias("member_state"))
    r = trades.where("disclosure_kind = 'senate-trade'").join(m, "member_id")
    low, high = F.col("amount_min"), F.col("amount_max")
    amount = F.when((low <= 0) & (high <= 0), F.lit("Pending amount normalization")).when(low == high, money(low)).otherwise(F.concat(money(low), F.lit(" to "), money(high)))
    summary = F.concat(F.lit("Senate trade disclosure for "), "member_name", F.lit(": "), "transaction_type", F.lit(" of "), F.coalesce("ticker", F.lit("asset")), F.lit(" on "), F.coalesce("transaction_date", F.lit("unknown date")), F.lit("."))
    content = lines(summary, *(labelled(a, v) for a, v in (("Ticker", F.col("ticker")), ("Asset description", F.col("asset_description")), ("Transaction type", F.col("transaction_type")), ("Transaction date", F.col("transaction_date")), ("Amount range", amount), ("Owner", F.col("owner")), ("Comment", F.col("comment")))))
    told = lambda x: F.when(F.col("crypto.kind") != "unrelated", F.col(f"crypto.{x}"))
    return document(r, F.concat(F.lit("senate-trade-"), "source_id"), F.concat("member_name", F.lit(" Senate trade disclosure")), content, F.col("source"), "stock-act", day="transaction_date", summary=summary, url="source_url", members=one(F.col("member_id")), tickers=one(F.col("ticker")),
                    tags=tags("senate-trade", *_TRADES, F.array("transaction_type", F.replace(F.lower("asset_type"), F.lit(" "), F.lit("-"))), keep_empty=True),
                    meta={"sourceId": "source_id", "memberSlug": "slug", "party": "party", "state": "member_state", "amountMin": "amount_min", "amountMax": "amount_max", "owner": "owner", "assetType": "asset_type", "comment": "comment", "cryptoKind": told("kind"), "cryptoSymbol": told("symbol")})


def offshore_match(matches: DataFrame, nodes: DataFrame) -> DataFrame:
    r = matches.join(nodes.select("node_key", F.col("content").alias("_content"), F.get_json_object("metadata", "$.sourceID").alias("_id")), "node_key")
    c = F.col
    content = F.concat_ws("\n", labelled("Matched member", c("member_name")), labelled("Offshore dataset", c("source_dataset")), labelled("Node type", c("node_type")), labelled("Node name", c("match_value")), "_content")
    return document(r, F.concat(F.lit("offshore-match-"), "node_key"), F.concat("member_name", F.lit(" cross-reference in "), "source_dataset"), content, "icij-offshore-leaks", "cross-reference", summary=F.concat("member_name", F.lit(" exactly matches an Offshore Leaks node in "), "source_dataset", F.lit(".")),
                    url=F.lit("https://offshoreleaks.icij.org/"), members=one(c("member_id")), tags=tags("offshore-leaks", "cross-reference", F.array("node_type", "source_dataset"), keep_empty=True),
                    meta={"nodeKey": "node_key", "nodeType": "node_type", "sourceDataset": "source_dataset", "matchType": "match_type", "matchValue": "match_value", "memberSlug": "member_slug"})


def fara_registrant(bundles: DataFrame) -> DataFrame:
    """Of registrants with lists foreign_principals, short_forms and documents, each in the order to show."""
    people = texts(F.transform("foreign_principals", lambda x: x["foreign_principal_name"]))
    forms = texts(F.transform("short_forms", lambda x: x["full_name"]))
    recent = F.transform(F.slice("documents", 1, 8), lambda x: F.concat(x["document_type"], F.lit(" ("), F.coalesce(x["date_stamped"], F.lit("undated")), F.lit(")")))
    content = lines(F.col("content"), labelled("Foreign principals", joined(people, 20)), labelled("Short-form registrants", joined(forms, 20)), labelled("Recent filings", joined(recent)))
    return document(bundles, F.concat(F.lit("fara-registrant-"), "registration_number"), F.concat("name", F.lit(" FARA registrant profile")), content, "fara", "lobbying", day="registration_date", summary="summary", url=F.lit("https://efile.fara.gov/"), tags=tags("fara", "foreign-agent", "registrant"),
                    meta={"registrationNumber": "registration_number", "foreignPrincipals": people, "shortForms": forms, "recentDocuments": F.transform(F.slice("documents", 1, 12), lambda x: x["url"])})


def fara_match(matches: DataFrame, registrants: DataFrame) -> DataFrame:
    r = matches.join(registrants.select("registration_number", F.col("content").alias("_content")), "registration_number")
    c = F.col
    content = F.concat_ws("\n", labelled("Matched member", c("member_name")), labelled("Match value", c("match_value")), labelled("Entity kind", c("entity_kind")), labelled("Registrant", c("registrant_name")), "_content")
    summary = F.concat("member_name", F.lit(" exactly matches a FARA "), F.replace("entity_kind", F.lit("_"), F.lit(" ")), F.lit(" linked to "), "registrant_name", F.lit("."))
    return document(r, F.concat(F.lit("fara-match-"), "entity_key"), F.concat("member_name", F.lit(" cross-reference in FARA registration "), "registration_number"), content, "fara", "cross-reference", summary=summary, url=F.lit("https://efile.fara.gov/"), members=one(c("member_id"), True),
                    tags=tags("fara", "cross-reference", F.array("entity_kind"), keep_empty=True), meta={"registrationNumber": "registration_number", "entityKind": "entity_kind", "entityKey": "entity_key", "matchType": "match_type", "matchValue": "match_value", "memberSlug": "member_slug", "registrantName": "registrant_name"})


def story_members(stories: DataFrame, members: DataFrame, key: str = "slug", refs: str = "member_refs") -> DataFrame:
    """(key, member_ids, member_slugs): a story's references by slug, else by name, distinct in their order."""
    from ..operators.resolve import resolve

    r = stories.select(F.col(key).alias("_story"), F.posexplode(objects(stories, refs, "slug:string,name:string")).alias("_at", "_ref"))
    r = r.select("_story", "_at", F.coalesce(F.trim("_ref.slug"), F.lit("")).alias("_slug"), blank_to_null("_ref.name").alias("_name"))
    by_slug = members.where("slug is not null and id is not null").groupBy(F.col("slug").alias("_slug")).agg(F.max(F.col("id").cast("string")).alias("_by_slug"))
    named = resolve(r.where("_name is not null").select(F.col("_name").alias("row_id"), F.col("_name").alias("name")).distinct(), members, state=None).select(F.col("row_id").alias("_name"), F.col("member_id").cast("string").alias("_by_name"))
    r = r.join(by_slug, "_slug", "left").join(named, "_name", "left").withColumn("_id", F.coalesce("_by_slug", "_by_name"))
    inorder = lambda v, ok: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(ok, F.struct("_at", F.col(v).alias("v"))))), lambda x: x["v"]))
    return r.groupBy(F.col("_story").alias(key)).agg(inorder("_id", F.col("_id").isNotNull()).alias("member_ids"), inorder("_slug", F.col("_slug") != "").alias("member_slugs"))


def story(stories: DataFrame, refs: DataFrame, site: str, name: str) -> DataFrame:
    """Of published stories; ``refs`` is what ``story_members`` gives."""
    r = stories.join(refs, "slug", "left")
    kind = F.coalesce(_n("category"), F.lit("general"))
    url = F.concat(F.lit(site.rstrip("/") + "/news/"), "slug")
    proof = F.size(objects(stories, "evidence", "description:string")) if "evidence" in stories.columns else F.lit(0)
    return document(r, F.concat(F.lit(f"{name}-story-"), "slug"), _t("title"), lines(_t("subtitle"), _t("excerpt"), _t("body"), by="\n\n"), name, "newsroom", day=date_of(F.coalesce(_n("published_at"), _n("updated_at"))), summary=F.coalesce(_n("excerpt"), _n("subtitle")), url=url, members=F.col("member_ids"),
                    tags=tags(name, "published-story", "newsroom", F.array(kind), strings(stories, "tags")),
                    meta={"slug": "slug", "author": _n("author"), "storyCategory": kind, "memberSlugs": F.coalesce("member_slugs", F.array().cast(_NONE)), "readingTime": "reading_time", "wordCount": "word_count", "publishedAt": _n("published_at"), "updatedAt": _n("updated_at"), "evidenceCount": proof})


def dossier(rows: DataFrame, site: str, name: str) -> DataFrame:
    found = objects(rows, "findings", "category:string,title:string,narrative:string")
    told = texts(F.flatten(F.transform(found, lambda f: F.array(f["title"], f["narrative"]))))
    grade, checked = F.coalesce(_n("severity"), F.lit("unknown")), F.coalesce(_n("verification_status"), F.lit("unverified"))
    content = lines(_t("summary"), _t("executive_summary"), _t("methodology"), joined(told, by="\n\n"), by="\n\n")
    return document(rows, F.concat(F.lit(f"{name}-dossier-"), _t("slug")), _t("title"), content, name, "newsroom", day=date_of(F.coalesce(_n("updated_at"), _n("generated_at"), _n("reviewed_at"))), summary=F.coalesce(_n("summary"), _n("executive_summary")), url=F.concat(F.lit(site.rstrip("/") + "/dossier/"), _t("slug")), members=one(_n("member_id")),
                    tags=tags(name, "dossier", "investigation", F.array(grade, checked), _field(found, "category")),
                    meta={"slug": _t("slug"), "memberId": "member_id", "severity": grade, "verificationStatus": checked, "findingCount": "finding_count", "generatedAt": _n("generated_at"), "reviewedAt": _n("reviewed_at"), "updatedAt": _n("updated_at"), "findingTitles": _field(found, "title")})


def member(rows: DataFrame, site: str, name: str) -> DataFrame:
    seats, traded = objects(rows, "committees", "id:string,name:string"), objects(rows, "top_tickers", "ticker:string,tradeCount:long")
    chamber, slug = _t("chamber"), _t("slug")
    house = F.when(chamber != "", F.lower(F.initcap(chamber))).otherwise(F.lit("congress"))
    summary = F.concat(_t("name"), F.lit(" is a "), _t("party"), F.lit(" "), house, F.lit(" member from "), _t("state"), F.when(_t("district") != "", F.concat(F.lit("-"), _t("district"))).otherwise(F.lit("")), F.lit("."))
    active = F.transform(F.filter(traded, lambda x: F.coalesce(x["ticker"], F.lit("")) != ""), lambda x: F.concat(x["ticker"], F.lit(" ("), F.coalesce(x["tradeCount"].cast("string"), F.lit("None")), F.lit(" trades)")))
    handle = F.when(_t("twitter_handle") != "", F.concat(F.lit("@"), _t("twitter_handle")))
    content = lines(summary, labelled("Office", _t("office")), labelled("Website", _t("website")), labelled("Twitter", handle), labelled("Committees", joined(_field(seats, "name"))), F.when(F.size(traded) > 0, F.concat(F.lit("Most active disclosed tickers: "), F.array_join(active, ", "))))
    return document(rows, F.concat(F.lit(f"{name}-member-"), F.coalesce(_n("slug"), _t("id"))), F.concat(_t("name"), F.lit(" member profile")), content, name, "member", summary=summary, url=F.when(slug != "", F.concat(F.lit(site.rstrip("/") + "/members/"), slug)), members=one(_n("id")), committees=_field(seats, "id"), tickers=F.transform(_field(traded, "ticker"), F.upper),
                    tags=tags(name, "member-profile", F.array(chamber, _t("party"), _t("state")), _field(seats, "name"), keep_empty=True),
                    meta={"slug": _n("slug"), "party": _n("party"), "state": _n("state"), "district": _n("district"), "chamber": _n("chamber"), "committeeNames": _field(seats, "name"), "topTickers": traded, "website": _n("website"), "twitterHandle": _n("twitter_handle")})


def committee(rows: DataFrame, site: str, name: str) -> DataFrame:
    seats, fields = objects(rows, "members", "id:string,name:string"), strings(rows, "jurisdiction_industries")
    names, people = _field(seats, "name"), _field(seats, "id")
    summary = F.concat(_t("name"), F.lit(" is a "), _t("chamber"), F.lit(" committee with "), F.size(people), F.lit(" tracked members."))
    content = lines(summary, labelled("Committee code", _t("code")), labelled("Jurisdiction industries", joined(fields)), labelled("Current members", joined(names, 40)), labelled("Official website", _t("url")))
    return document(rows, F.concat(F.lit(f"{name}-committee-"), _t("id")), F.concat(_t("name"), F.lit(" committee profile")), content, name, "committee", summary=summary, url=F.concat(F.lit(site.rstrip("/") + "/committees/"), _t("id")), members=people, committees=F.array(_t("id")),
                    tags=tags(name, "committee-profile", F.array(_t("chamber"), _t("code")), fields, keep_empty=True),
                    meta={"committeeId": _t("id"), "committeeCode": _n("code"), "chamber": _n("chamber"), "officialUrl": _n("url"), "memberCount": F.size(people), "memberNames": names, "jurisdictionIndustries": fields})


def bill(rows: DataFrame, site: str, name: str) -> DataFrame:
    introduced, acted = date_of(F.col("introduced_date").cast("string")), date_of(F.col("last_action_date").cast("string"))
    subjects, fields, seats = (strings(rows, c) for c in ("subjects", "industries", "committees"))
    title, short, kind, number = _t("title"), _t("short_title"), _t("bill_type"), _t("number")
    content = lines(title, F.when(short != title, short), labelled("Sponsor", _t("sponsor_name")), labelled("Status", _t("status")), labelled("Introduced", introduced), labelled("Last action", acted), labelled("Subjects", joined(subjects)), labelled("Industries", joined(fields)), labelled("Committees", joined(seats)))
    full = F.when((kind != "") & (number != ""), F.concat(title, F.lit(" ("), F.upper(kind), F.lit(" "), number, F.lit(")"))).otherwise(title)
    return document(rows, F.concat(F.lit(f"{name}-bill-"), _t("id")), full, content, name, "bill", day=F.coalesce(acted, introduced), summary=F.coalesce(_n("short_title"), _n("title")), url=F.concat(F.lit(site.rstrip("/") + "/bills/"), _t("id")), members=one(_n("sponsor_id")), bills=F.array(_t("id")),
                    tags=tags(name, "bill", F.array(_t("status"), kind), subjects, fields, keep_empty=True),
                    meta={"billId": _t("id"), "billType": _n("bill_type"), "number": _n("number"), "status": _n("status"), "introducedDate": introduced, "lastActionDate": acted, "sponsorName": _n("sponsor_name"), "sponsorSlug": _n("sponsor_slug"), "subjects": subjects, "industries": fields, "committees": seats})


def alert(rows: DataFrame, site: str, name: str) -> DataFrame:
    tickers, titles = F.transform(strings(rows, "trade_tickers"), F.upper), strings(rows, "bill_titles")
    proof = objects(rows, "evidence", "description:string")
    content = lines(_n("summary"), labelled("Member", _t("member_name")), labelled("Severity", _t("severity")), labelled("Confidence", F.col("confidence")), labelled("Trade tickers", joined(tickers)), labelled("Related bills", joined(titles)), joined(_field(proof, "description"), by="\n"))
    return document(rows, F.concat(F.lit(f"{name}-alert-"), _t("id")), _t("title"), content, name, "alert", day=date_of(F.coalesce(_n("updated_at"), _n("created_at"))), summary=_n("summary"), url=F.concat(F.lit(site.rstrip("/") + "/alerts/"), _t("id")), members=one(_n("member_id")), bills=strings(rows, "bill_ids"), tickers=tickers,
                    tags=tags(name, "alert", F.array(_t("alert_type"), _t("severity"), _t("status")), keep_empty=True),
                    meta={"alertId": _t("id"), "alertType": _n("alert_type"), "severity": _n("severity"), "status": _n("status"), "memberName": _n("member_name"), "memberSlug": _n("member_slug"), "confidence": "confidence", "billTitles": titles, "evidenceCount": F.size(proof)})


def bill_context(bills: DataFrame, summaries: DataFrame, actions: DataFrame, site_rows: DataFrame) -> DataFrame:
    """Of official bills with their summaries and actions and what the site has (id, sponsor_*, industries, subjects, committees)."""
    first = summaries.where("rank = 1").select("bill_key", F.col("text").alias("_summary"), "version_code", F.col("action_date").alias("_version_day"))
    n = summaries.groupBy("bill_key").agg(F.count("*").alias("_summaries"))
    line = F.concat(F.coalesce("action_date", F.lit("Undated")), F.lit(": "), "text")
    last = actions.where("rank <= 8").groupBy("bill_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("v"), "text"))), lambda x: x["v"]).alias("_recent"), F.min_by("text", "rank").alias("_action"))
    m = actions.groupBy("bill_key").agg(F.count("*").alias("_actions"))
    s = site_rows.select(F.col("id").cast("string").alias("site_bill_id"), F.col("sponsor_id").cast("string").alias("_sponsor"), F.col("sponsor_name").alias("_sponsor_name"), F.col("sponsor_slug").alias("_sponsor_slug"), strings(site_rows, "industries").alias("_industries"), strings(site_rows, "subjects").alias("_subjects"), strings(site_rows, "committees").alias("_committees"))
    r = bills.join(first, "bill_key", "left").join(n, "bill_key", "left").join(last, "bill_key", "left").join(m, "bill_key", "left").join(s, "site_bill_id", "left")
    none = lambda c: F.coalesce(c, F.array().cast(_NONE))
    subjects, seats = F.array_distinct(F.concat("subjects", none("_subjects"))), F.array_distinct(F.concat("committee_names", none("_committees")))
    sponsor = F.coalesce(_n("_sponsor_name"), F.col("sponsor_full_name"))
    body = F.coalesce("_summary", "summary")
    content = lines(body, labelled("Latest action", F.col("_action")), labelled("Sponsor", sponsor), labelled("Policy area", F.col("policy_area")), labelled("Committees", joined(seats)), labelled("Subjects", joined(subjects)), labelled("Recent actions", joined(none("_recent"), by=" | ")), by="\n\n")
    return document(r, F.concat(F.lit("congress-bill-"), "bill_key"), F.col("title"), content, "congress-gov", "bill", day=F.coalesce("update_date_including_text", "update_date", "latest_action_date", "introduced_date"), summary=body, url="legislation_url", members=one(F.col("_sponsor")), bills=one(F.col("site_bill_id")),
                    tags=tags("congress-gov", "official-bill-context", F.array("bill_type", F.coalesce("origin_chamber", F.lit("")), F.coalesce("policy_area", F.lit(""))), subjects, none("_industries"), keep_empty=True),
                    meta={"billKey": "bill_key", "siteBillId": _n("site_bill_id"), "billType": "bill_type", "billNumber": "bill_number", "congress": "congress", "originChamber": "origin_chamber", "policyArea": "policy_area", "committeeNames": seats, "committeeCodes": "committee_codes", "subjects": subjects, "industries": none("_industries"), "sponsorBioguideId": "sponsor_bioguide_id",
                          "sponsorName": sponsor, "sponsorSlug": _n("_sponsor_slug"), "summaryVersionCode": "version_code", "summaryActionDate": "_version_day", "actionsCount": F.coalesce("_actions", F.lit(0)), "summariesCount": F.coalesce("_summaries", F.lit(0))})


def spending_match(matches: DataFrame, awards: DataFrame) -> DataFrame:
    """Of company matches and their award records, the first twelve by amount."""
    line = F.concat_ws(" | ", *(F.when(F.coalesce(x, F.lit("")) != "", x) for x in (F.col("award_id"), F.col("awarding_agency"), money(F.col("award_amount")), F.col("description"))))
    top = awards.groupBy("match_key").agg(F.transform(F.slice(F.array_sort(F.collect_list(F.struct((-F.coalesce("award_amount", F.lit(0.0))).alias("o"), "award_key", line.alias("v")))), 1, 12), lambda x: x["v"]).alias("_awards"))
    r = matches.join(top, "match_key", "left")
    agencies = F.coalesce("top_agencies", F.array().cast(_NONE))
    content = lines(F.col("content"), labelled("Recipient name", F.col("recipient_name")), labelled("Top agencies", joined(agencies)), labelled("Recipient code", F.col("recipient_code")), labelled("UEI", F.col("uei")), F.array_join("_awards", "\n"))
    meta = {"companyId": "company_id", "companyName": "company_name", "ticker": "ticker", "queryName": "query_name", "recipientId": "canonical_recipient_id", "recipientName": "recipient_name", "recipientCode": "recipient_code", "uei": "uei", "totalAmount": "total_amount", "awardCount": "award_count", "topAgencies": agencies, "matchType": "match_type", "matchValue": "match_value"}
    return document(r, F.concat(F.lit("usaspending-match-"), "match_key"), F.concat("company_name", F.lit(" federal spending profile")), content, "usaspending", "contracts", summary="summary", url="source_url", tickers=one(F.col("ticker")), tags=tags("usaspending", "federal-spending", "contracts", F.array(F.coalesce("ticker", F.lit(""))), agencies, keep_empty=True), meta=meta)

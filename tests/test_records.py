"""Feeds, records and documents on small landed files; survey ids are in the tests' names and comments."""

import hashlib
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.records import documents, fara, legislation, lobbying, matches, offshore, spending, trades
from ledgerlens.sources import feeds

MEMBERS = [("m1", "B1", "Jane Doe", "jane-doe", "D", "CA"), ("m2", "B2", "Richard Roe", "richard-roe", "R", "TX"), ("m3", "B3", "Ann Murray", "ann-murray", "D", "WA")]


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(MEMBERS, "id string, bioguide_id string, name string, slug string, party string, state string")


def put(folder, name, x):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(x if isinstance(x, str) else json.dumps(x))
    return path


def zipped(folder, name, **entries):
    path = os.path.join(folder, name)
    with zipfile.ZipFile(path, "w") as z:
        for k, v in entries.items():
            z.writestr(k.replace("__", "/").replace("_csv", ".csv").replace("_", "-"), v)
    return path


def test_s1_f1_n19_house_feed(spark, tmp_path):
    row = lambda **k: "<Member>" + "".join(f"<{a}>{b}</{a}>" for a, b in k.items()) + "</Member>"
    xml = "<FinancialDisclosure>" + row(DocID="100", FilingType="P", First="Jane", Last="Doe", StateDst="CA12", FilingDate="1/5/2026") + row(DocID="", FilingType="P") + row(DocID="101", FilingType="C") + row(DocID="102", StateDst="tx", FilingDate="2026-01-09") + row(DocID="103", FilingType="ptr", Last="Roe", StateDst="TX01") + "</FinancialDisclosure>"
    got = {r["doc_id"]: r for r in feeds.house_filings(spark, put(tmp_path, "2026FD.xml", xml), 2026, "https://x.test/pdf").collect()}
    assert set(got) == {"100", "102", "103"}
    a, b = got["100"], got["102"]
    assert (a["filing_date"], a["state"], a["district"], a["member_name"], a["source_url"]) == ("2026-01-05", "CA", "12", "Jane Doe", "https://x.test/pdf/2026/100.pdf")
    assert (b["filing_type"], b["state"], b["district"], b["member_name"], b["filing_date"]) == ("PTR", "TX", None, "House PTR 102", "2026-01-09") and got["103"]["member_name"] == "Roe"


def test_s2_s18_landed_reports_and_those_not_yet_read(spark, tmp_path):
    for name, data in (("7.pdf", b"%PDF-1"), ("8.pdf", b"<html>"), ("9.pdf", b"%PDF-2")):
        (tmp_path / name).write_bytes(data)
    files = feeds.pdf_files(spark, str(tmp_path))
    done = spark.createDataFrame([(hashlib.sha256(b"%PDF-1").hexdigest(),)], "file_hash string")
    assert sorted(r["doc_id"] for r in files.collect()) == ["7", "9"] and [r["doc_id"] for r in feeds.not_yet_read(files, done).collect()] == ["9"]


def test_s3_p7_t10_watcher_trades(spark, tmp_path, members):
    rows = [{"transaction_date": "01/05/2026", "owner": "Spouse", "ticker": "msft", "asset_description": "Microsoft", "asset_type": "Stock", "type": "Sale (Full)", "amount": "$1,001 - $15,000", "comment": "--x", "senator": "Jane Doe", "ptr_link": "https://e.test/1/"},
            {"transaction_date": "01/06/2026", "ticker": "--", "asset_description": "Bitcoin", "type": "Purchase", "amount": "Over $50,000,000", "senator": "Richard Roe"}, {"transaction_date": "N/A", "senator": "Jane Doe"}, {"transaction_date": "01/06/2026", "senator": "Nobody Known"}, {"transaction_date": "01/06/2026"}]
    t = trades.watcher_trades(feeds.senate_watcher(spark, put(tmp_path, "w.json", rows)), members)
    a, b = sorted(t.collect(), key=lambda r: r["transaction_date"])
    assert (a["member_id"], a["ticker"], a["transaction_type"], a["owner"], a["amount_min"], a["amount_max"], a["asset_type"], a["source"]) == ("m1", "MSFT", "sale", "spouse", 1001, 15000, "Stock", "senate-watcher")
    content = "|".join(["m1", "MSFT", "microsoft", "sale", "2026-01-05", "1001", "15000", "spouse", "https://e.test/1"])
    assert a["source_id"] == "tr-senate-" + hashlib.sha256(content.encode()).hexdigest()[:16]
    assert (b["ticker"], b["asset_type"], b["amount_min"], b["crypto"]["symbol"]) == (None, "Cryptocurrency", 50000000, "BTC")
    assert [r["transaction_date"] for r in trades.newest_first(t).collect()] == ["2026-01-06", "2026-01-05"] and trades.newest_first(t, "2026-01-06").count() == 1 and trades.newest_first(t, limit=1).count() == 1


def test_s4_s5_p7_bulk_and_live_trades(spark, tmp_path, members):
    page = [{"Name": "X Roe", "BioGuideID": "b2", "Chamber": "Senate", "Traded": "2026-02-01", "Filed": "20260210", "Ticker": "ETHA", "Transaction": "Exchange", "Trade_Size_USD": "$15,001 - $50,000", "Company": "iShares", "Subholding": "Trust", "Comments": "note"},
            {"Name": "Jane Doe", "House": "Representatives", "Traded": "2026-02-01"}, {"Name": "Jane Doe", "BioGuideID": "zz", "House": "senate", "Traded": "2026-02-01"}]
    put(tmp_path, "p1.json", page), put(tmp_path, "p2.json", page[:1])
    got = trades.bulk_trades(feeds.congress_bulk(spark, str(tmp_path)), members).collect()
    assert len(got) == 1 and (got[0]["member_id"], got[0]["asset_type"], got[0]["disclosure_date"], got[0]["comment"], got[0]["asset_description"], got[0]["owner"]) == ("m2", "Crypto ETF", "2026-02-10", "Trust | note", "iShares", "self")
    live = feeds.senate_live(spark, put(tmp_path, "live.json", [{"Senator": "Ann Murray", "Date": "2026-03-01", "last_modified": "2026-03-04", "Range": "1000", "Ticker": "T", "Transaction": "Receive"}]))
    r = trades.bulk_trades(live, members).first()
    assert (r["member_id"], r["amount_min"], r["amount_max"], r["transaction_type"], r["disclosure_date"], r["asset_type"]) == ("m3", 1000, 1000, "receive", "2026-03-04", "Stock")


def test_p5_p6_p11_k4_c2_house_trades_and_stored_rows(spark):
    stubs = spark.createDataFrame([("9", 2026, "PTR", "2026-01-09", "Jane", "Doe", "m1", "Jane Doe", "CA", "12", "house-clerk", "https://x.test/9.pdf", "CA12")], "doc_id string, filing_year int, filing_type string, filing_date string, first_name string, last_name string, member_id string, member_name string, state string, district string, source string, source_url string, raw_state_district string")
    results = spark.createDataFrame([("9", 0.85)], "doc_id string, parser_confidence double")
    deals = spark.createDataFrame([("9", 1, "COIN", "Coinbase", "Stock", "sale", "2026-01-02", 1001, 15000, "self"), ("9", 3, None, "Acme Corp", "Stock", "purchase", "2026-01-03", 0, 0, "joint")], "doc_id string, line_number int, ticker string, asset_description string, asset_type string, transaction_type string, transaction_date string, amount_min long, amount_max long, owner string")
    t = trades.house_trades(stubs, results, deals)
    p = {r["id"]: r for r in trades.payload(t).collect()}
    assert set(p) == {"tr-house-9-1", "tr-house-9-3"}
    assert (p["tr-house-9-1"]["asset_type"], p["tr-house-9-1"]["crypto_kind"], p["tr-house-9-1"]["source"], p["tr-house-9-1"]["comment"]) == ("Crypto-Adjacent Equity", "crypto_equity", "house_clerk", "Parsed from House PTR 9 at 85% confidence")
    assert p["tr-house-9-3"]["crypto_kind"] is None and p["tr-house-9-3"]["conflict_score"] == 0 and p["tr-house-9-3"]["conflict_flags"] == []
    assert trades.payload(t.withColumn("member_id", F.lit(None).cast("string"))).count() == 0
    q = trades.stub_payload(stubs)
    meta = json.loads(q.first()["metadata"])
    assert meta["docId"] == "9" and meta["memberSlug"] is None and meta["filingYear"] == 2026 and q.first()["status"] == "pending_extraction"
    back = trades.stubs_of(q.withColumn("source", F.lit("house_clerk"))).first()
    assert (back["member_name"], back["state"], back["source"], back["filing_type"], back["member_id"], back["raw_state_district"]) == ("Jane Doe", "CA", "house-clerk", "PTR", "m1", "CA12")
    stored = trades.payload(t)
    again = {r["source_id"]: r for r in trades.trades_of(stored).collect()}
    assert set(again) == {"9-1", "9-3"} and again["9-1"]["source"] == "house-clerk" and again["9-1"]["crypto"]["kind"] == "crypto_equity"
    table = spark.createDataFrame([("a", "BTC", "Bitcoin", "Stock"), ("b", None, "Ethereum", "Stock"), ("c", "MSFT", "Microsoft", "Stock"), ("d", "COIN", "Coinbase", "Crypto-Adjacent Equity")], "id string, ticker string, asset_description string, asset_type string")
    assert {tuple(r) for r in trades.reclassified(table).collect()} == {("a", "Cryptocurrency", "BTC"), ("b", "Cryptocurrency", "ETH")}


def test_n11_sources(spark):
    rows = spark.createDataFrame([("senate-ethics",), ("other-feed",)], "s string")
    assert [r[0] for r in rows.select(trades.stored_source(F.col("s"))).collect()] == ["senate_efd", "other_feed"]


def test_s6_s7_p1_fara(spark, tmp_path):
    bulk = zipped(tmp_path, "a.zip", a_csv='"Foreign Principal",Registration Number ,"Country/Location Represented","Foreign Principal Registration Date","State"\n"Société\nX","77","FRANCE","01/02/2026"," CA ","extra"\n'.encode("latin-1"), b_csv="x\n1\n")
    r = fara.principals(feeds.fara_bulk(spark, bulk)).collect()
    assert len(r) == 1 and (r[0]["foreign_principal_name"], r[0]["registration_number"], r[0]["country_name"], r[0]["state"], r[0]["registrant_name"]) == ("Société\nX", 77, "FRANCE", "CA", "Registrant 77")
    assert r[0]["principal_key"] == hashlib.sha1("77|Société\nX|FRANCE|2026-01-02".encode()).hexdigest() and json.loads(r[0]["metadata"])["State"] == " CA "
    for name, x in (("1.json", {"R": {"ROW": [{"Registration_Number": 5, "Name": "Acme", "Address_1": "1 St", "City": "Rome"}, 3]}}), ("2.json", {"R": {"ROW": {"Registration_Number": "6"}}}), ("3.json", {"R": [{"Registration_Number": "8", "Name": "List"}]}), ("4.json", {"R": {}}), ("5.json", {"Q": 1})):
        put(tmp_path, name, x)
    got = {r["registration_number"]: r for r in fara.registrants(feeds.fara_api(spark, str(tmp_path / "*.json"), "R")).collect()}
    assert set(got) == {5, 6, 8} and got[6]["name"] == "FARA registrant 6"
    assert got[5]["content"] == "Registrant: Acme\nRegistration number: 5\nRegistration date: Unknown\nAddress: 1 St, Rome" and got[5]["summary"].endswith("registration number 5.")
    assert [r["registration_number"] for r in fara.page(fara.registrants(feeds.fara_api(spark, str(tmp_path / "*.json"), "R")), 1, 1, spark.createDataFrame([(6,)], "registration_number int")).collect()] == [8]  # T11
    rows = spark.createDataFrame([({"REG_NUMBER": "5", "SF_FIRST_NAME": "Ann", "SF_LAST_NAME": "Murray", "SHORTFORM_DATE": "2026-01-02"},), ({"REG_NUMBER": "5"},)], "row map<string,string>")
    a, b = sorted(fara.short_forms(rows).collect(), key=lambda r: r["full_name"])
    assert (a["full_name"], a["short_form_key"], b["full_name"]) == ("Ann Murray", hashlib.sha1(b"5|Ann Murray|2026-01-02").hexdigest(), "Short form 5")
    d = fara.documents(spark.createDataFrame([({"REGISTRATION_NUMBER": "5", "URL": "u", "DATE_STAMPED": "odd"},)], "row map<string,string>")).first()
    assert (d["document_type"], d["date_stamped"], d["document_key"]) == ("FARA filing", "odd", hashlib.sha1(b"5||odd|u").hexdigest())


def test_s8_s9_p2_p12_c6_offshore(spark, tmp_path, members):
    entities = 'node_id,name,countries,sourceID,jurisdiction,note\n1,Acme,"France;Korea, Republic of|france",Papers,BVI,\n,none,,,,\n'
    path = zipped(tmp_path, "o.zip", x__nodes_entities_csv=entities, x__nodes_officers_csv="node_id,name,countries\n2,Jane Doe,\n3,Nobody,\n", x__relationships_csv="node_id_start,node_id_end,rel_type,link\n1,2,officer_of,x\n")
    n = offshore.nodes(feeds.offshore_nodes(spark, path))
    got = {r["node_key"]: r for r in n.collect()}
    assert set(got) == {"entity:1", "officer:2", "officer:3"}
    assert got["entity:1"]["countries"] == ["France", "Korea", "Republic of"] and got["entity:1"]["summary"] == "Acme | Papers | France, Korea, Republic of | BVI" and got["officer:2"]["source_dataset"] == "Offshore Leaks"
    assert got["officer:2"]["content"] == "Jane Doe\nOfficer or beneficial owner record" and feeds.offshore_nodes(spark, path, ["officer"], 1).count() == 1
    edge = offshore.links(feeds.offshore_links(spark, path)).first()
    assert edge["relationship_key"] == hashlib.sha1(b"1|2|officer_of|x|Offshore Leaks").hexdigest()
    m = matches.offshore(n, members)
    r = m.collect()
    assert len(r) == 1 and (r[0]["member_id"], r[0]["match_key"], r[0]["matched_kind"]) == ("m1", hashlib.sha1(b"m1|officer:2|exact_name").hexdigest(), "key")
    d = documents.offshore_match(m, n).first()
    assert d["id"] == "doc-offshore-match-officer:2" and d["content"].startswith("Matched member: Jane Doe\nOffshore dataset: Offshore Leaks\nNode type: officer\nNode name: Jane Doe\nJane Doe") and d["tags"] == ["offshore-leaks", "cross-reference", "officer", "Offshore Leaks"]


def test_p12_c6_p9_fara_matches_and_documents(spark, members):
    rows = spark.createDataFrame([({"Registration_Number": "5", "Name": "Jane Doe", "State": "CA"},), ({"Registration_Number": "6", "Name": "Acme LLC"},)], "row map<string,string>")
    reg = fara.registrants(rows)
    fp = fara.principals(spark.createDataFrame([({"REG_NUMBER": "6", "FP_NAME": "Nation"},)], "row map<string,string>"))
    sf = fara.short_forms(spark.createDataFrame([({"REG_NUMBER": "6", "SF_FIRST_NAME": "Ann", "SF_LAST_NAME": "Murray", "STATE": "WA"},)], "row map<string,string>"))
    m = matches.fara(reg, fp, sf, members)
    got = {r["entity_kind"]: r for r in m.collect()}
    assert set(got) == {"registrant", "short_form"} and got["registrant"]["match_key"] == hashlib.sha1(b"m1|registrant|5|Jane Doe|exact_name").hexdigest() and got["short_form"]["registrant_name"] == "Acme LLC"
    d = {r["source_document_id"]: r for r in documents.fara_match(m, reg).collect()}
    assert d["fara-match-5"]["summary"] == "Jane Doe exactly matches a FARA registrant linked to Jane Doe." and d["fara-match-5"]["member_ids"] == ["m1"]
    some = lambda df, *c: df.groupBy("registration_number").agg(F.collect_list(F.struct(*c)).alias("x"))
    b = reg.join(some(fp, "foreign_principal_name").withColumnRenamed("x", "foreign_principals"), "registration_number").join(some(sf, "full_name").withColumnRenamed("x", "short_forms"), "registration_number").withColumn("documents", F.array(F.struct(F.lit("Exhibit").alias("document_type"), F.lit(None).cast("string").alias("date_stamped"), F.lit("u").alias("url"))))
    r = documents.fara_registrant(b).first()
    assert r["content"].endswith("Foreign principals: Nation\nShort-form registrants: Ann Murray\nRecent filings: Exhibit (undated)") and json.loads(r["metadata"])["recentDocuments"] == ["u"] and r["tags"] == ["fara", "foreign-agent", "registrant"]


def test_s10_s12_s13_p3_d4_t9_spending(spark, tmp_path):
    put(tmp_path, "r.json", {"results": [{"recipient_id": "R1", "name": "Acme Inc", "code": "c", "uei": "u", "amount": 1234567.5, "total_outlays": 2.0}, {"recipient_id": "R2"}]})
    rec = spending.recipients(feeds.json_results(spark, str(tmp_path / "r.json"), spending.RECIPIENT), F.lit("ACME"))
    got = {r["recipient_id"]: r for r in rec.collect()}
    assert got["R1"]["summary"] == "Acme Inc received approximately $1,234,568 in tracked federal spending during the queried window." and "Federal spending: $1,234,567.50" in got["R1"]["content"] and got["R2"]["name"] == "Recipient R2" and "UEI: None" in got["R2"]["content"]
    text = "recipient_name,contract_award_unique_key,award_id_piid,current_total_value_of_award,total_obligated_amount,awarding_agency_name,award_latest_action_date\nACME INC.,k1,P1,10,,NASA,2026-01-01\nAcme Inc,k1,P1,99,,NASA,\nacme inc,,P2,,30,DoD,\nOther,k9,P9,5,,X,\nAcme Inc,,,7,,X,\n"
    path = zipped(tmp_path, "aw.zip", Contracts_PrimeAwardSummaries_1_csv="﻿" + text, Contracts_Subawards_PrimeAwardSummaries_csv=text)
    aw = spending.awards_of(feeds.award_rows(spark, path), F.lit("Acme, Inc."), 5)
    assert [(r["award_id"], r["award_amount"], r["generated_internal_id"]) for r in aw.collect()] == [("P2", 30.0, "P2"), ("P1", 10.0, "k1")] and spending.awards_of(feeds.award_rows(spark, path), F.lit("Acme Inc"), 1).count() == 1
    ag = spark.createDataFrame([("1", "NASA", None, 5.0), ("2", "DoD", None, 9.0)], spending.AGENCY), spark.createDataFrame([("1", "NASA", None, 8.0), (None, "GSA", None, None)], spending.AGENCY)
    agencies = spending.agencies_of(*ag, 3)
    assert [(r["name"], r["amount"]) for r in agencies.collect()] == [("DoD", 9.0), ("NASA", 8.0), ("GSA", None)]
    companies = spark.createDataFrame([("c1", "Acme", "ACM", "R1")], "company_id string, company_name string, ticker string, recipient_id string")
    mine = aw.withColumn("recipient_id", F.lit("R1"))
    for own, top in ((agencies.withColumn("recipient_id", F.lit("R1")), ["DoD", "NASA", "GSA"]), (agencies.withColumn("recipient_id", F.lit("R9")), ["DoD", "NASA"])):
        m = spending.company_matches(companies, rec, mine, own)
        r = m.first()
        assert r["match_key"] == hashlib.sha1(b"c1|R1").hexdigest() and r["top_agencies"] == top and r["award_count"] == 2 and "Top awards: P2 (DoD, $30); P1 (NASA, $10)" in r["content"]
    a = {x["award_id"]: x for x in spending.award_records(m, mine).collect()}
    assert a["P1"]["award_key"] == hashlib.sha1(f"{r['match_key']}|P1||k1".encode()).hexdigest() and a["P1"]["award_amount"] == 10.0
    d = documents.spending_match(m, spending.award_records(m, mine)).first()
    assert d["source_document_id"] == f"usaspending-match-{r['match_key']}" and d["content"].endswith("P2 | DoD | $30\nP1 | NASA | $10") and d["tags"] == ["usaspending", "federal-spending", "contracts", "ACM", "DoD", "NASA"]
    names = spark.createDataFrame([(["b", "a", "a", "c", "b", "a"],)], "x array<string>").select(spending.most_common(F.col("x"), 2)).first()[0]
    assert names == ["a", "b"]
    best = spending.best_recipients(spark.createDataFrame([("c1", "R1", 85, 5.0, 1), ("c1", "R1", 85, 9.0, 2), ("c1", "R2", 55, None, 3)], "company_id string, recipient_id string, score int, amount double, seq int"))
    assert sorted((r["recipient_id"], r["seq"]) for r in best.collect()) == [("R1", 2), ("R2", 3)]  # D5


def test_s14_p4_t8_a15_bills(spark, tmp_path):
    put(tmp_path, "bill.json", {"bill": {"congress": 119, "type": "HR", "number": "7", "title": "An Act", "policyArea": {"name": "Energy"}, "sponsors": [{"bioguideId": "B1", "fullName": "Rep. Doe"}], "introducedDate": "2026-01-02", "latestAction": {"actionDate": "2026-02-01", "text": "Passed"}, "updateDate": "2026-02-02T01:00:00Z", "legislationUrl": "https://l.test/7", "cosponsors": {"count": 3}}})
    put(tmp_path, "s1.json", {"summaries": [{"versionCode": "00", "actionDate": "2026-01-02", "text": "<p>First &amp; old</p>"}, {"text": "  "}]}), put(tmp_path, "s2.json", {"summaries": [{"versionCode": "36", "actionDate": "2026-02-01", "text": "Newest"}]})
    put(tmp_path, "a.json", {"actions": [{"actionDate": "2026-01-03", "text": "Referred", "committees": [{"name": "Energy C", "systemCode": "e1"}, {"name": " "}], "sourceSystem": {"code": 2, "name": "House"}}, {"actionDate": "2026-02-01", "actionTime": "10:00", "text": "Passed", "committees": [{"name": "Rules", "systemCode": "r1"}, {"name": "Energy C", "systemCode": "e1"}]}]})
    key = "119-hr-7"
    s = legislation.summaries(feeds.json_results(spark, str(tmp_path / "s*.json"), legislation.SUMMARY, "summaries").withColumn("bill_key", F.lit(key)))
    a = legislation.actions(feeds.json_results(spark, str(tmp_path / "a.json"), legislation.ACTION, "actions").withColumn("bill_key", F.lit(key)))
    assert [(r["rank"], r["text"], r["summary_key"]) for r in s.orderBy("rank").collect()] == [(1, "Newest", hashlib.sha1(b"119-hr-7|36|2026-02-01||Newest").hexdigest()), (2, "First & old", hashlib.sha1(b"119-hr-7|00|2026-01-02||First & old").hexdigest())]
    assert a.where("rank = 1").first()["text"] == "Passed"
    site = spark.createDataFrame([(4, 119, "hr", "7", "An act", "Short", ["Oil", " "], "2026-01-01"), (5, 118, "S", "9", "Other", None, None, "2025-05-01T00:00:00")], "id int, congress int, bill_type string, number string, title string, short_title string, subjects array<string>, introduced_date string")
    official = feeds.json_object(spark, str(tmp_path / "bill.json"), legislation.BILL, "bill").withColumn("site_bill_id", F.lit("4"))
    got = {r["site_bill_id"]: r for r in legislation.bills(site, official, s, a).collect()}
    x, y = got["4"], got["5"]
    assert (x["bill_key"], x["title"], x["committee_names"], x["committee_codes"], x["summary"], x["cosponsors_count"], x["committees_count"], x["summaries_count"], x["sponsor_full_name"]) == (key, "An Act", ["Rules", "Energy C"], ["r1", "e1"], "Newest", 3, 2, 2, "Rep. Doe")
    assert x["content"] == "Newest\n\nPassed\n\nPolicy area: Energy\n\nCommittees: Rules, Energy C\n\nSubjects: Oil" and x["api_url"].endswith("/119/hr/7?format=json")
    assert (y["bill_key"], y["title"], y["introduced_date"], y["summary"], y["content"], y["actions_count"]) == ("118-s-9", "Other", "2025-05-01", None, "", 0)
    rows = spark.createDataFrame([("4", "m1", "Jane Doe", "jane-doe", '["Oil","Gas"]', '["Coal"]', None)], "id string, sponsor_id string, sponsor_name string, sponsor_slug string, industries string, subjects string, committees string")
    d = {r["source_document_id"]: r for r in documents.bill_context(legislation.bills(site, official, s, a), s, a, rows).collect()}[f"congress-bill-{key}"]
    assert d["document_date"] == "2026-02-02T01:00:00Z" and d["tags"] == ["congress-gov", "official-bill-context", "hr", "", "Energy", "Oil", "Coal", "Gas"] and "Recent actions: 2026-02-01: Passed | 2026-01-03: Referred" in d["content"] and d["member_ids"] == ["m1"]


def test_s15_p8_lobbying(spark, tmp_path):
    f = {"filing_uuid": "u1", "filing_type": "Q1", "filing_period": "first_quarter", "filing_year": 2026, "income": "1200.50", "dt_posted": "2026-04-01T10:00:00", "registrant": {"id": 3, "name": "Firm"}, "client": {"id": 4, "name": "Client"},
         "lobbying_activities": [{"general_issue_code": "TAX", "description": "d1", "lobbyists": [{"first_name": "Ann", "last_name": "Lee"}], "government_entities": [{"name": "SENATE"}]}, {"general_issue_code": "ENG"}, {"general_issue_code": "TAX", "lobbyists": [{"first_name": "Ann", "last_name": "Lee"}]}]}
    got = {r["id"]: r for r in lobbying.filings(feeds.json_results(spark, put(tmp_path, "f.json", {"results": [f, {"expenses": "7"}]}), lobbying.FILING)).collect()}
    r = got["lda-u1"]
    assert (r["amount"], r["issue_codes"], r["lobbyists"], r["filing_period"], r["filing_date"], r["registrant_id"], r["gov_entities"], r["specific_bills"]) == (1200, ["ENG", "TAX"], ["Ann Lee"], "2026_first_quarter", "2026-04-01", "3", ["SENATE"], ["d1"])
    assert len(got) == 2 and sorted(r["amount"] for r in got.values()) == [7, 1200]
    c = [{"filing_uuid": "v", "contribution_items": [{"amount": "5", "recipient_name": "R", "contribution_type": "feca"}], "pacs": ["P ", {"name": "Q", "amount": 2}, ""], "lobbyist": {"first_name": "Bo"}}, {"filing_uuid": "w", "no_contributions": True, "pacs": ["x"]}, {"filing_uuid": "y"}]
    rows = lobbying.contributions(feeds.json_results(spark, put(tmp_path, "c.json", {"results": c}), lobbying.CONTRIBUTION)).collect()
    assert len(rows) == 1 and rows[0]["id"] == "lda-contrib-v" and rows[0]["lobbyist_name"] == "Bo" and [tuple(i) for i in rows[0]["contribution_items"]] == [("5", "R", "feca", None), (None, "P", "PAC", None), ("2", "Q", "PAC", None)]


def test_s17_k15_registry(spark, tmp_path, members):
    feeds.write_registry(members, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    assert feeds.member_registry(spark, put(tmp_path, "m.json", [{"id": "1", "name": "A"}])).first()["name"] == "A"
    with pytest.raises(ValueError):
        feeds.member_registry(spark, put(tmp_path, "n.json", {"id": "1"}))


def test_p9_site_documents(spark, members):
    story = spark.createDataFrame([("s1", "T", "Sub", "", "Body", "Al", None, ["a", "", "a"], '[{"slug":"jane-doe"},{"name":"Ann Murray"},{"slug":"gone"}]', "2026-01-02 10:00", "[{}]", 3, 400)], "slug string, title string, subtitle string, excerpt string, body string, author string, category string, tags array<string>, member_refs string, published_at string, evidence string, reading_time int, word_count int").withColumn("updated_at", F.lit(None).cast("string"))
    r = documents.story(story, documents.story_members(story, members), "https://s.test/", "site").first()
    assert (r["id"], r["member_ids"], r["document_date"], r["content"], r["summary"], r["tags"], r["source_url"]) == ("doc-site-story-s1", ["m1", "m3"], "2026-01-02", "Sub\n\nBody", "Sub", ["site", "published-story", "newsroom", "general", "a"], "https://s.test/news/s1")
    assert json.loads(r["metadata"])["memberSlugs"] == ["jane-doe", "gone"] and json.loads(r["metadata"])["evidenceCount"] == 1
    row = {"slug": "d", "title": "D", "summary": "S", "executive_summary": "E", "methodology": None, "severity": None, "verification_status": "verified", "findings": '[{"category":"c","title":"t1","narrative":"n1"},{"title":"t2"}]', "member_id": "m1", "finding_count": 2, "generated_at": None, "reviewed_at": None, "updated_at": "2026-03-01T00:00"}
    text = lambda row: spark.createDataFrame([{k: v for k, v in row.items()}], ", ".join(f"{k} {'int' if k in ('finding_count',) else 'double' if k == 'confidence' else 'string'}" for k in row))
    r = documents.dossier(text(row), "https://s.test", "site").first()
    assert r["content"] == "S\n\nE\n\nt1\n\nn1\n\nt2" and r["tags"] == ["site", "dossier", "investigation", "unknown", "verified", "c"] and json.loads(r["metadata"])["findingTitles"] == ["t1", "t2"]
    row = {"id": "m1", "slug": "", "name": "Jane Doe", "party": "D", "state": "CA", "district": "12", "chamber": "house", "office": "O", "website": None, "twitter_handle": "jd", "committees": '[{"id":"c1","name":"Rules"}]', "top_tickers": '[{"ticker":"msft","tradeCount":4}]'}
    r = documents.member(text(row), "https://s.test", "site").first()
    assert r["source_document_id"] == "site-member-m1" and r["source_url"] is None and r["content"] == "Jane Doe is a D house member from CA-12.\nOffice: O\nTwitter: @jd\nCommittees: Rules\nMost active disclosed tickers: msft (4 trades)" and r["asset_tickers"] == ["MSFT"] and r["tags"] == ["site", "member-profile", "house", "D", "CA", "Rules"]
    row = {"id": "c1", "name": "Rules", "chamber": "house", "code": "", "url": "u", "jurisdiction_industries": '["Oil"]', "members": json.dumps([{"id": str(i), "name": f"N{i}"} for i in range(45)])}
    r = documents.committee(text(row), "https://s.test", "site").first()
    assert r["tags"] == ["site", "committee-profile", "house", "", "Oil"] and r["content"].splitlines()[2].endswith("N39") and len(r["member_ids"]) == 45 and "45 tracked members" in r["summary"]
    row = {"id": "b1", "bill_type": "hr", "number": "7", "title": "An Act", "short_title": "Act", "sponsor_id": "m1", "sponsor_name": "Jane", "sponsor_slug": None, "status": "", "introduced_date": "2026-01-02T00:00", "last_action_date": None, "subjects": "Oil", "industries": None, "committees": '["Rules"]'}
    r = documents.bill(text(row), "https://s.test", "site").first()
    assert (r["title"], r["summary"], r["document_date"], r["tags"], r["bill_ids"]) == ("An Act (HR 7)", "Act", "2026-01-02", ["site", "bill", "", "hr", "Oil"], ["b1"]) and r["content"] == "An Act\nAct\nSponsor: Jane\nIntroduced: 2026-01-02\nSubjects: Oil\nCommittees: Rules"
    row = {"id": "a1", "title": "A", "summary": "S", "alert_type": "t", "severity": "high", "status": "open", "member_id": "m1", "member_name": "Jane", "member_slug": None, "confidence": 0.5, "bill_ids": '["b1"]', "trade_tickers": "msft", "bill_titles": None, "evidence": '[{"description":"e1"},{"description":""}]', "updated_at": None, "created_at": "2026-05-01"}
    r = documents.alert(text(row), "https://s.test", "site").first()
    assert r["content"] == "S\nMember: Jane\nSeverity: high\nConfidence: 0.5\nTrade tickers: MSFT\ne1" and r["asset_tickers"] == ["MSFT"] and r["tags"] == ["site", "alert", "t", "high", "open"] and json.loads(r["metadata"])["evidenceCount"] == 2


def test_p9_house_and_senate_documents(spark, members):
    stubs = spark.createDataFrame([("9", 2026, "PTR", "2026-01-09", "m1", "Jane Doe", "https://x.test/9.pdf")], "doc_id string, filing_year int, filing_type string, filing_date string, member_id string, member_name string, source_url string")
    res = spark.createDataFrame([("9", 0.85, "raw text", 2)], "doc_id string, parser_confidence double, raw_text_preview string, n int")
    tr = spark.createDataFrame([("house-ptr", "9:1", "MSFT"), ("house-ptr", "9:2", None)], "disclosure_kind string, source_id string, ticker string")
    r = documents.house_report(stubs, res, tr).first()
    assert (r["id"], r["title"], r["tags"], r["asset_tickers"], r["content"], r["category"]) == ("doc-house-ptr-9", "Jane Doe House PTR 9", ["house-ptr", "stock-act", "congressional-trades", "ticker-linked"], ["MSFT"], "raw text", "stock-act") and "2 parsed transactions" in r["summary"]
    q = spark.createDataFrame([("9", 2026, "u", "needs_review", json.dumps({"memberName": "Jane", "memberId": "m1", "parsedTransactions": [{"ticker": "b"}, {"ticker": "A"}, {"ticker": None}]})), ("10", 2026, None, "parsed", None)], "doc_id string, filing_year int, source_url string, status string, metadata string")
    got = {x["source_document_id"]: x for x in documents.house_stub(q).collect()}
    assert got["house-ptr-9"]["asset_tickers"] == ["A", "B"] and json.loads(got["house-ptr-9"]["metadata"])["parsedTransactionCount"] == 3 and got["house-ptr-10"]["title"] == "House PTR 10 House PTR 10" and "deeper review" in got["house-ptr-10"]["summary"]
    t = spark.createDataFrame([{"senator": "Jane Doe", "transaction_date": "2026-01-05", "type": "Sale", "ticker": "MSFT", "asset_description": "Microsoft", "asset_type": "Stock Option", "amount": "$1,001 - $15,000", "owner": "Self", "comment": None, "ptr_link": None}], "transaction_date string, owner string, ticker string, asset_description string, asset_type string, type string, amount string, comment string, senator string, ptr_link string")
    r = documents.senate_trade(trades.watcher_trades(t, members), members).first()
    assert r["summary"] == "Senate trade disclosure for Jane Doe: sale of MSFT on 2026-01-05." and "Amount range: $1,001 to $15,000" in r["content"] and r["tags"] == ["senate-trade", "stock-act", "congressional-trades", "sale", "option"]

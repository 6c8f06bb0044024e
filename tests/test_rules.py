"""Expressions and keyed tables on single values; survey ids are in the tests' names."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import collections as coll
from ledgerlens.functions import dates, money, text
from ledgerlens.operators import match, ptr, store
from ledgerlens.rules import codes


@pytest.fixture(scope="module")
def over(spark):
    """Values of an expression of column x over given texts."""
    def run(f, *xs):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x string")
        return [r["v"] for r in df.select("i", f(F.col("x")).alias("v")).orderBy("i").collect()]
    return run


def test_f16_retryable(over):
    assert over(codes.retryable, "PTR PDF fetch failed with 404", "PTR PDF fetch failed with 500", "Read TIMED OUT", "connection reset by peer", "connection refused", "temporarily unavailable", None) == [True, False, True, True, False, True, False]


def test_w5_outcomes(spark):
    rows = [(1, "m", 0.6, None), (1, "m", 0.59, None), (0, "m", 0.9, None), (1, "", 0.9, None), (1, None, 0.9, None), (None, "m", None, "x timeout y"), (3, "m", 0.9, "bad"), (None, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t int, m string, c double, e string")
    assert [r[0] for r in df.orderBy("i").select(codes.outcome(F.col("t"), F.col("m"), F.col("c"), F.col("e"))).collect()] == ["parsed"] + ["needs_review"] * 4 + ["pending_extraction"] + ["needs_review"] * 2


def test_mj_merges_keep_types(spark):
    rows = [('{"n":1,"o":{"b":2},"l":[1,2],"s":"1"}', '{"z":true,"s":null}'), (None, '{"a":1.5}'), ('{"a":1}', None), (None, None), ("not json", '{"a":"b"}')]
    got = [json.loads(r[0]) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i").select(coll.merge_json("a", "b")).collect()]
    assert got[1:] == [{"a": 1.5}, {"a": 1}, {}, {"a": "b"}]
    assert {k: got[0][k] for k in "nolz"} == {"n": 1, "o": {"b": 2}, "l": [1, 2], "z": True} and got[0].get("s") is None


def test_k1_k2_upserts(spark):
    day = lambda x: F.to_date(F.lit(x))
    old = spark.createDataFrame([("a", 1, "old-a", "kept"), ("b", 2, "old-b", "kept")], "k string, v int, id string, more string").withColumns({"created_at": day("2025-01-01"), "updated_at": day("2025-01-01")})
    batch = spark.createDataFrame([("a", 5, "new-a", 1), ("a", 6, "newer", 2), ("c", 7, "new-c", 1)], "k string, v int, id string, seq int")
    got = {r["k"]: r for r in store.upsert(old, batch, ["k"], "seq", day("2026-01-01"), keep=("id",)).collect()}
    assert [(k, got[k]["v"], got[k]["id"], got[k]["more"], str(got[k]["created_at"]), str(got[k]["updated_at"])) for k in "abc"] == [("a", 6, "old-a", "kept", "2025-01-01", "2026-01-01"), ("b", 2, "old-b", "kept", "2025-01-01", "2025-01-01"), ("c", 7, "new-c", None, "2026-01-01", "2026-01-01")]


def test_k3_needs_review_goes_back(spark):
    old = spark.createDataFrame([("1", "parsed", '{"a":1}'), ("2", "needs_review", None), ("3", "extracting", "{}"), ("4", "needs_review", None)], "doc_id string, status string, metadata string")
    new = spark.createDataFrame([("1", '{"b":2}'), ("2", '{"b":2}'), ("3", "{}"), ("9", "{}")], "doc_id string, metadata string")
    strict, lax = ({r["doc_id"]: r["status"] for r in store.sync_queue(old, new, "doc_id", strict=s).collect()} for s in (True, False))
    assert strict == {"1": "parsed", "2": "pending_extraction", "3": "extracting", "4": "needs_review", "9": "pending_extraction"} and lax["2"] == "needs_review"


def test_k7_k8_k9_updates(spark):
    t = spark.createDataFrame([("1", "new", '{"a":1}', [0.5], "X"), ("2", "new", None, None, None)], "k string, status string, metadata string, vector array<float>, ticker string")
    c = spark.createDataFrame([("1", "parsed", '{"b":[2]}', [1.0, 2.0], ""), ("3", "x", None, None, None)], "k string, status string, metadata string, vector array<float>, ticker string")
    got = {r["k"]: r for r in store.update_by_key(t, c, "k", "status", "vector", "ticker", merge=("metadata",)).collect()}
    assert (got["1"]["status"], json.loads(got["1"]["metadata"]), got["1"]["vector"], got["1"]["ticker"]) == ("parsed", {"a": 1, "b": [2]}, [1.0, 2.0], "X") and tuple(got["2"]) == ("2", "new", None, None, None) and len(got) == 2


def test_k5_k6_k11_children(spark):
    kids = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 1)], "doc string, n int")
    touched = spark.createDataFrame([("d1",), ("d3",)], "doc string")
    assert sorted(map(tuple, store.replace_children(kids, kids.where("false"), touched, "doc").collect())) == [("d2", 1)]
    assert sorted(map(tuple, store.cascade(kids, touched, "doc").collect())) == [("d2", 1)] and store.orphans(kids, touched.withColumnRenamed("doc", "id"), "doc", "id").count() == 1
    kept, gone = store.prune(kids, F.col("n") == 1, touched, "doc")
    assert kept.count() == 2 and [tuple(r) for r in gone.collect()] == [("d2", 1)]


def test_s16_stored_tables(spark, tmp_path):
    t = store.Table(spark, str(tmp_path / "t"))
    assert t.read() is None
    for n in (1, 2, 3, 4):
        t.write(spark.range(n))
    assert t.read().count() == 4 and t.versions() == [2, 3, 4]


def test_x5_x7_f2_f10_f9_dates(spark, over):
    assert over(dates.date_of, "2026-01-02T10:00", "2026-01-02 10:00", "2026-01-02", " ", None) == ["2026-01-02", "2026-01-02", "2026-01-02", None, None]
    now = F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")
    rows = spark.createDataFrame([(0, True), (3, True), (3, False), (99, False)], "n int, gone boolean")
    got = [r[0] for r in rows.select(((dates.retry_after(now, F.col("n"), F.col("gone")) - now).cast("long") if False else (F.unix_timestamp(dates.retry_after(now, F.col("n"), F.col("gone"))) - F.unix_timestamp(now)) / 60)).collect()]
    assert got == [15, 45, 30, 360]
    today = F.to_date(F.lit("2026-06-01"))
    assert over(lambda x: dates.date_issue(x, F.lit("2026-05-01"), today), "", None, "2026-02-31", "2026-05-02", "2026-04-30") == ["missing", "missing", "invalid", "after_filing", None]
    assert over(lambda x: dates.valid_on(F.to_date(x), today), None, "2026-06-01", "2026-05-31") == [True, True, False]


def test_m3_m6_numbers(over):
    assert over(money.to_double, "1,200.5", " 7 ", "x", "", None) == [1200.5, 7.0, None, None, None]
    assert over(money.to_long, "1,200", "12.0", "x", None) == [1200, 12, None, None]
    assert over(lambda x: money.dollars(x.cast("double")), "1234.5", "1235.5", "-3", "0") == ["$1,234", "$1,236", "$-3", "$0"]


def test_n7_n9_n10_codes(over):
    assert over(lambda x: codes.owner(F.lit(""), x), "SP", "JT", "DC", "Spouse/DC x", "") == ["spouse", "joint", "child", "spouse", "self"]
    assert over(codes.senate_action, "Sale (Partial)", "Exchange", "Receive", None, "Purchase") == ["sale", "exchange", "receive", "purchase", "purchase"]
    assert over(codes.senate_owner, "Joint", "Self", "--", None) == ["joint", "self", "self", "self"]
    assert over(codes.senate_asset, "Corporate Bond", "Stock Option", "Mutual Fund", "ETF", None) == ["Bond", "Option", "Fund", "ETF", "Stock"]
    assert over(codes.house_asset, "st", "OP", "??") == ["Stock", "Option", "Asset"] and over(codes.house_action, "S (partial)", "E", "P") == ["sale", "exchange", "purchase"]


def test_n13_n14_n15_companies(over):
    assert over(text.strip_corporate, "Acme Holdings, Inc.", "Inc.", "Plain") == ["Acme", None, "Plain"]
    assert over(text.company_tokens, "The Acme Global Systems Inc", "A & B Micro Devices") == [["acme", "global"], ["micro", "devices"]]
    assert over(text.alias_key, "Acme, Inc.", "") == ["ACME", None]
    assert over(text.name_variants, "A&B Co.") == [["A&B Co", "AANDB Co", "A B Co"]]
    assert over(lambda x: text.company_query(x, F.lit("msft")), "Microsoft Corp (MSFT)", "$1,001 Acme Corp - Common Stock", "My IRA) Acme", "Broker > Zeta Class A", "Code   Beta LLC", "Gamma Inc (NYSE)", "direction. x\nAcme Corp (MSFT)\nPortfolio rebalance", None, " ") == ["Microsoft Corp", "Acme Corp", "Acme", "Zeta", "Beta LLC", "Gamma Inc", "Acme Corp", None, None]
    assert over(lambda x: text.company_queries(x, F.lit("Oracle Corp Common Stock"), F.lit("orcl")), "Oracle Corporation") == [["Oracle Corp", "Oracle", "Oracle Corporation", "ORACLE AMERICA", "ORACLE USA"]]
    assert over(text.company_queries, "AT&T Inc.", None) == [["AT&T Inc", "ATANDT Inc", "AT T Inc", "AT&T", "ATANDT", "AT T"], []]


def test_c3_c4_c5_d6_t9_recipients(spark, over):
    assert over(lambda x: match.score(F.lit("Acme Rocket Motors Inc"), x), "ACME ROCKET MOTORS LLC", "Acme Rocket Motors Western", "Acme Rocket Shoes", "Zeta", None) == [100, 85, 65, 0, 0]
    assert over(lambda x: match.profile_score(F.lit("Acme"), F.array(x, F.lit("Acme Corp"))), "Zeta") == [100]
    rows = [("c", "Acme", f"Acme {s}", f"r{i}", a) for i, (s, a) in enumerate((("Corp", 5.0), ("LLC", 9.0), ("Corp", None), ("Rockets", 1.0)))] + [("c", "Acme", "Acme Corp", "r0", 2.0)]
    got = match.select_matches(spark.createDataFrame(rows, "company string, query string, name string, recipient string, amount double"), "query", "name", "company", "amount", "recipient", limit=2)
    assert sorted(r["recipient"] for r in got.collect()) == ["r0", "r1"]


def test_a12_n8_o2_report_results(spark):
    page = "Name: Hon. Jane Q. Doe Status: Member State/District: CA12 Cap. Gains > $200? SP Acme Corp (ACM) [ST] P 1/2/2026 1/3/2026 $15,001 - $50,000 Z Beta Fund [MF] S (partial) 1/4/2026 1/5/2026 JT $1,001 - $15,000"
    docs = spark.createDataFrame([("1", page, "u", "2026-02-01", "From Feed"), ("2", "nothing", "u", "2026-02-01", None)], "doc_id string, text string, source_url string, filing_date string, member_name string")
    results, rows = ptr.parse(docs, F.to_date(F.lit("2026-03-01")))
    got = {r["doc_id"]: r for r in results.collect()}
    deals = rows.orderBy("line_number").collect()
    assert (got["1"]["member_name"], got["1"]["state"], got["1"]["n_transactions"]) == ("Jane Q. Doe", "CA", 2) and got["2"]["parser_confidence"] == 0 and got["2"]["n_transactions"] == 0
    assert got["1"]["parser_confidence"] == pytest.approx(0.81) and len(got["1"]["raw_text_preview"]) <= 1200
    assert [(r["asset_description"], r["ticker"], r["owner"], r["asset_type"], r["transaction_type"]) for r in deals] == [("Acme Corp", "ACM", "spouse", "Stock", "purchase"), ("Beta Fund", None, "joint", "Mutual Fund", "sale")]
    none, _ = ptr.parse(docs.where("false"), F.to_date(F.lit("2026-03-01")))
    assert none.count() == 0


def test_a2_a6_u3_collections(spark, over):
    rows = spark.createDataFrame([("b", 2), ("a", 5)], "k string, n int")
    assert json.loads(rows.agg(coll.count_map(F.col("k"), F.col("n"))).first()[0]) == {"a": 5, "b": 2}
    assert over(coll.string_list, '["a"," b"]', "x", "", None) == [["a", " b"], ["x"], [], []]
    assert over(lambda x: coll.drop_empty(F.create_map(F.lit("a"), x, F.lit("b"), F.lit("1"))), " ", "v") == [{"b": "1"}, {"a": "v", "b": "1"}]


def test_r3_indexed_search_finds_what_a_scan_finds(spark):
    from ledgerlens.operators import search

    rows = [(1, "d1", "the committee on energy met; energy committees meeting"), (2, "d1", "committee energy"), (3, "d2", "energy and commerce committee"), (4, "d2", ""), (5, "d3", None), (6, "d3", "a bill on oil and gas leases, oil and gas")]
    docs = spark.createDataFrame(rows, "chunk_id long, document_id string, content string")
    index = search.inverted(docs)
    for q in ("energy committee", '"energy committee"', "oil or energy", "energy -commerce", '"oil and gas" or commerce', "the", "", "nowhere", '"committee energy" -met'):
        scan = {(r["chunk_id"], r["lexical_score"]) for r in search.lexical(docs, q, 10).collect()}
        assert {(r["chunk_id"], r["lexical_score"]) for r in search.indexed(index, q, 10).collect()} == scan, q
    scores = {r["chunk_id"]: r["lexical_score"] for r in search.indexed(index, "energy committee", None).collect()}
    assert scores == pytest.approx({1: 0.5, 2: 1.0, 3: 1 / 3})  # one word between, none, two
    assert [r["chunk_id"] for r in search.indexed(index, '"committee energy"', None).collect()] == [2]
    found = search.indexed(index, "energy", None)
    whole = spark.createDataFrame([("d3", 2.0), ("d1", 1.0)], "document_id string, lexical_score double")
    assert [(r["chunk_id"], r["lexical_score"]) for r in search.with_documents(found, whole, docs, 9).collect()] == [(1, 3.0), (2, 2.0), (5, 2.0), (6, 2.0), (3, 1.0)]

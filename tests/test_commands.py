"""Jobs over landed files and a store; queues, readings, indexing. Survey ids are in the tests' names and comments."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_records import MEMBERS, put, zipped

from ledgerlens import commands
from ledgerlens.operators import indexing, ocr, queues
from ledgerlens.schemas import COUNTERS, TABLES, Store, check_vectors

PAGE = "SP Acme Corp (ACM) [ST] P 1/2/2026 1/3/2026 $15,001 - $50,000 Z Bitcoin (BTC) [CS] S (partial) 1/4/2026 1/5/2026 JT $1,001 - $15,000"


def now():
    return F.lit(dt.datetime(2026, 6, 1)).cast("timestamp")


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(MEMBERS, "id string, bioguide_id string, name string, slug string, party string, state string")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_k12_a7_schemas_and_status(store):
    assert store.ensure("trades", "search_chunks") == ["trades", "search_chunks"] and store.ensure("trades") == []
    assert commands.corpus_status(store) == {c: 0 for c in COUNTERS} and len(COUNTERS) == 19 and set(t for t, _ in COUNTERS.values()) <= set(TABLES)


def test_f7_f8_t2_due(spark):
    meta = lambda **k: json.dumps(k)
    rows = [("a", "pending_extraction", meta(), 1), ("b", "pending_extraction", meta(retryAfter="2026-06-02T00:00:00Z"), 2), ("c", "pending_extraction", meta(retryAfter="2026-05-02T00:00:00Z"), 3), ("d", "pending_extraction", meta(lastError="ptr pdf fetch failed with 404 x"), 4),
            ("e", "extracting", meta(retryAfter=""), 5), ("f", "needs_review", meta(), 6), ("g", "parsed", meta(), 7), ("h", "pending_extraction", meta(lastError=queues.MANUAL, retryAfter="2027-01-01T00:00:00Z"), 8), ("i", "extracting", None, 9)]
    q = spark.createDataFrame(rows, "doc_id string, status string, metadata string, day int").withColumn("detected_at", F.date_add(F.to_date(F.lit("2026-01-01")), "day").cast("timestamp"))
    assert [r["doc_id"] for r in queues.due(q, now(), 9).collect()] == ["c", "a", "i", "e"]
    assert [r["doc_id"] for r in queues.due(q, now(), 9, "too").collect()] == ["c", "a", "i", "e", "f"] and [r["doc_id"] for r in queues.due(q, now(), 9, "only").collect()] == ["h", "f"] and queues.due(q, now(), 0).count() == 1


def test_f4_f5_w8_w9_filters(spark):
    rows = spark.createDataFrame([("a", "2026-01-02"), ("a", "2026-01-02"), ("b", None), ("c", "2025-01-01"), ("d", "2026-02-01")], "id string, day string")
    assert sorted(r["id"] for r in queues.fresh(rows, "id", spark.createDataFrame([("d",)], "id string"), "day", "2026-01-01").collect()) == ["a", "b"]
    got = spark.createDataFrame([(1, 200), (2, 500), (3, 429), (4, 200)], "seq int, http_status int")
    assert [r["seq"] for r in queues.until_refused(got).orderBy("seq").collect()] == [1, 2] and queues.until_refused(got.where("seq < 3")).count() == 2
    good, bad = queues.quarantined(spark.createDataFrame([("x", "y"), ("", "y"), (None, " ")], "a string, b string"), "a", "b")
    assert good.count() == 1 and sorted(r["lacks"] for r in bad.collect()) == [["a"], ["a", "b"]]


def test_o3_o4_o5_a13_readings(spark):
    prose = "it is the end of the road and that is a fact for it"
    ocr.register("broken", lambda content: 1 / 0)
    ocr.register("weak", lambda content: ["éé éé", content.decode()[:3]])
    files = spark.createDataFrame([("1", bytearray(prose.encode())), ("2", bytearray(b"\xff")), ("3", bytearray(b"zz qq"))], "doc_id string, content binary")
    r = ocr.with_confidence(ocr.read(files, ("broken", "weak", "missing", "text")))
    rows = {(x["doc_id"], x["backend"]): x for x in r.collect()}
    assert rows["1", "broken"]["error"] == "division by zero" and rows["1", "missing"]["error"] == "the back end isn't installed" and rows["2", "text"]["pages"] is None
    assert rows["1", "weak"]["low_pages"] == [1] and rows["1", "text"]["low_pages"] == [] and rows["1", "text"]["page_confidences"] == [rows["1", "text"]["confidence"]]
    best = {x["doc_id"]: x["backend"] for x in ocr.first_good(r).collect()}
    assert best["1"] == "text" and best["3"] == max(("weak", "text"), key=lambda b: rows["3", b]["confidence"]) and "2" not in best
    assert {x["backend"] for x in ocr.first_good(r, threshold=0.0).where("doc_id = '1'").collect()} == {"weak"}


def test_o8_o9_o10_k5_k9_j1_indexing(spark, store):
    with pytest.raises(ValueError):
        indexing.embedder("nobody")
    embed = indexing.embedder("hashed", dim=8)
    record = lambda key, text: (f"doc-{key}", key, key.upper(), text, "s", "c")
    rows = lambda *x: spark.createDataFrame([record(*r) for r in x], "id string, source_document_id string, title string, content string, source string, category string").withColumns({"member_ids": F.array(F.lit("m1")), "tags": F.array().cast("array<string>")})
    long = "\n\n".join(f"paragraph {i} " + "word " * 200 for i in range(8))
    assert commands.index(store, rows(("a", long), ("b", "short text")), now())["documents"] == 2
    store.write("search_documents", store.read("search_documents").withColumn("id", F.when(F.col("source_document_id") == "a", "kept-id").otherwise(F.col("id"))))
    n = store.read("search_chunks").where("document_id = 'doc-a'").count()
    assert n > 1 and indexing.lacking(store.read("search_chunks")).count() == n + 1
    commands.index(store, rows(("a", "now short")), now())
    chunks = store.read("search_chunks")
    assert sorted(r["id"] for r in chunks.where("document_id <> 'doc-a'").collect()) == ["doc-b:chunk:0", "kept-id:chunk:0"]  # K2
    assert commands.embed_backlog(store, None, 1) == {"batches": 1, "embedded": 0, "left": n + 2}  # no progress ends it
    assert commands.embed_backlog(store, embed, 2, most=1) == {"batches": 1, "embedded": 2, "left": n}
    assert commands.embed_backlog(store, embed, 2)["left"] == 0 and commands.embed_backlog(store, embed, 2)["batches"] == 0
    vectors = [r["embedding"] for r in store.read("search_chunks").collect()]
    assert all(len(v) == 8 and abs(sum(x * x for x in v) - 1) < 1e-5 for v in vectors)
    check_vectors(store.read("search_chunks"), 8)
    with pytest.raises(ValueError):
        check_vectors(store.read("search_chunks"), 9)
    got = commands.hybrid_search(store, "short", None, 5, member_ids="m1").collect()
    assert {r["id"] for r in got} == {"doc-b:chunk:0", "kept-id:chunk:0"} and commands.hybrid_search(store, "nowhere").count() == 0  # R7
    commands.index(store, rows(("b", "")), now())
    assert store.read("search_chunks").where("document_id = 'doc-b'").count() == 0


def test_cm_house_jobs(spark, store, members, tmp_path):
    row = lambda **k: "<Member>" + "".join(f"<{a}>{b}</{a}>" for a, b in k.items()) + "</Member>"
    feed = lambda *rows: put(tmp_path, "f.xml", "<F>" + "".join(rows) + "</F>")
    one, two, three = row(DocID="1", First="Jane", Last="Doe", StateDst="CA12", FilingDate="2/1/2026"), row(DocID="2", First="No", Last="Body", StateDst="ZZ"), row(DocID="3", Last="Roe", StateDst="TX01", FilingDate="2/1/2026")
    assert commands.sync_house_feed(store, feed(one, two, three), 2026, members, now()) == {"filings": 3, "resolved": 2, "pruned": 0}
    texts = spark.createDataFrame([("1", PAGE, None), ("2", PAGE, None), ("3", None, "PTR PDF fetch failed with 404")], "doc_id string, text string, error string")
    got = commands.process_house_backlog(store, texts, members, now())
    assert got == {"processed": 3, "trades": 2, "indexed": 2, "states": {"parsed": 1, "needs_review": 1, "pending_extraction": 1}}
    q = {r["doc_id"]: r for r in store.read("house_filing_stubs").collect()}
    assert q["1"]["status"] == "parsed" and json.loads(q["3"]["metadata"])["attempts"] == 1 and json.loads(q["3"]["metadata"])["retryAfter"] == "2026-06-01T00:15:00Z" and json.loads(q["1"]["metadata"])["memberId"] == "m1"
    assert commands.process_house_backlog(store, texts, members, now())["processed"] == 0
    assert commands.sync_house_feed(store, feed(one, two), 2026, members, now())["pruned"] == 1  # K6
    assert {r["doc_id"]: r["status"] for r in store.read("house_filing_stubs").collect()} == {"1": "parsed", "2": "pending_extraction"}
    assert commands.corpus_status(store)["search_documents"] == 2 and commands.latest_disclosure(store, "house_clerk") == "2026-02-01"  # W2
    store.write("trades", store.read("trades").withColumn("asset_type", F.lit("Stock")))
    assert commands.backfill_crypto(store) == {"updated": 1, "kinds": {"Cryptocurrency": 1}} and commands.classify_asset(store, "IBIT", None)["kind"] == "crypto_etf"


def test_cm_senate_job(spark, store, members):
    rows = spark.createDataFrame([("Jane Doe", "2026-01-01", "2026-01-10", "MSFT"), ("Jane Doe", "2026-01-01", "2026-01-10", "MSFT"), ("Ann Murray", "2025-01-01", "2025-01-10", "T")], "Name string, Traded string, Filed string, Ticker string")
    empty = {c: F.lit(None).cast("string") for c in "BioGuideID|Company|Transaction|Trade_Size_USD|Amount|Chamber|State|Description|TickerType|Subholding|Comments|Representative|TransactionDate|ReportDate|QuiverUploadTime".split("|")}
    rows = rows.withColumns(empty | {"House": F.lit("Senate")})
    assert commands.ingest_senate(store, rows, members, now(), "2026-01-01") == {"feed": 3, "normalized": 3, "new": 1, "indexed": 1}
    assert commands.ingest_senate(store, rows, members, now(), "2025-01-01")["new"] == 1 and store.read("trades").count() == 2


def test_cm_register_jobs(spark, store, members, tmp_path):
    path = zipped(tmp_path, "o.zip", nodes_officers_csv="node_id,name\n2,Jane Doe\n", relationships_csv="node_id_start,node_id_end,rel_type\n1,2,x\n")
    assert commands.ingest_offshore(store, path, members, now()) == {"nodes": 1, "relationships": 1, "matches": 1, "documents": 1, "chunks": 1}
    maps = lambda *rows: spark.createDataFrame([(r,) for r in rows], "row map<string,string>")
    got = commands.ingest_fara(store, maps({"Registration_Number": "5", "Name": "Acme"}, {"Registration_Number": "6", "Name": "Late"}), maps({"REG_NUMBER": "5", "FP_NAME": "Nation"}, {"REG_NUMBER": "9"}), maps({"REG_NUMBER": "5", "SF_FIRST_NAME": "Ann", "SF_LAST_NAME": "Murray"}), maps({"REGISTRATION_NUMBER": "5", "URL": "u"}), members, now(), limit=1)
    assert (got["fara_registrants"], got["fara_foreign_principals"], got["fara_short_forms"], got["fara_documents"], got["fara_matches"], got["documents"]) == (1, 1, 1, 1, 1, 2)
    site = spark.createDataFrame([("m1", "jane-doe", "Jane Doe", "D", "CA", "12", "house")], "id string, slug string, name string, party string, state string, district string, chamber string").withColumns({c: F.lit(None).cast("string") for c in ("office", "website", "twitter_handle")})
    assert commands.index_site(store, now(), "https://s.test", "site", member=site)["documents"] == 1
    assert commands.corpus_status(store)["search_documents"] == 4

"""The jobs a user runs: each takes landed files and a store, writes the store's tables and returns a summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators import indexing, ptr, queues, search
from .operators.relational import pick_per_key
from .operators.resolve import resolve
from .operators.store import prune, sync_queue, update_by_key, upsert
from .records import documents, fara, legislation, matches, offshore, spending, trades
from .rules.crypto import classify
from .schemas import Store, check_vectors
from .sources import feeds

_OFFSHORE = {"offshore_nodes": "node_key", "offshore_relationships": "relationship_key", "offshore_matches": "match_key"}


def _keep(store: Store, name: str, key: str, rows: DataFrame, now: Column) -> int:
    """Upserts rows, the last of a key as they came, and counts what the table has then."""
    batch = rows.withColumn("_seq", F.lit(0))
    store.write(name, upsert(store.read(name), batch, [key], "_seq", now))
    return store.read(name).count()


def ensure(store: Store, *names: str) -> dict:
    return {"made": store.ensure(*names)}


def corpus_status(store: Store) -> dict:
    return store.status().first().asDict()


def index(store: Store, records: DataFrame, now: Column, embed: indexing.Embedder | None = None) -> dict:
    """Search records into the store, with their chunks."""
    held = store.read("search_documents"), store.read("search_chunks")
    docs, chunks = indexing.index(*held, records.withColumn("seq", F.lit(0)), embed, now)
    store.write("search_documents", docs)
    store.write("search_chunks", chunks)
    return {"documents": records.count(), "chunks": store.read("search_chunks").count()}


def sync_house_feed(store: Store, path: str, year: int, members: DataFrame, now: Column) -> dict:
    """A year's filings into the queue; rows that vanished from the index after their report wasn't found go."""
    spark = store.spark
    stubs = feeds.house_filings(spark, path, year)
    who = resolve(stubs.select(F.col("doc_id").alias("row_id"), F.col("member_name").alias("name"), "state", F.col("first_name").alias("first"), F.col("last_name").alias("last")), members, first="first", last="last")
    m = members.select(F.col("id").alias("member_id"), F.col("name").alias("_name"), F.col("slug").alias("member_slug"), "party")
    stubs = stubs.join(who.select(F.col("row_id").alias("doc_id"), "member_id"), "doc_id", "left").join(m, "member_id", "left").withColumn("member_name", F.coalesce("_name", "member_name"))
    new, old = trades.stub_payload(stubs), store.read("house_filing_stubs")
    queue = sync_queue(old.select("doc_id", "status", "metadata"), new.select("doc_id", "metadata"), "doc_id")
    rest = old.select("doc_id", "filing_year", "source", "source_url", "extracted_trade_id", "detected_at", F.col("last_seen_at").alias("_seen"))
    told = new.select("doc_id", F.col("filing_year").alias("_y"), F.col("source").alias("_s"), F.col("source_url").alias("_u"))
    both = queue.join(rest, "doc_id", "left").join(told, "doc_id", "left").withColumns({"filing_year": F.coalesce("_y", "filing_year"), "source": F.coalesce("_s", "source"), "source_url": F.coalesce("_u", "source_url"), "detected_at": F.coalesce("detected_at", now), "last_seen_at": F.when(F.col("_u").isNotNull(), now).otherwise(F.col("_seen"))})
    gone = (F.col("filing_year") == year) & F.replace("source", F.lit("_"), F.lit("-")).eqNullSafe(F.lit("house-clerk")) & (F.col("status") == "pending_extraction") & queues.error_begins(queues.NOT_THERE)
    kept, removed = prune(both, gone, new, "doc_id")
    summary = {"filings": new.count(), "resolved": stubs.where("member_id is not null").count(), "pruned": removed.count()}
    store.write("house_filing_stubs", kept)
    return summary


def process_house_backlog(store: Store, texts: DataFrame, members: DataFrame, now: Column, limit: int = 10, review: str = "no", embed: indexing.Embedder | None = None) -> dict:
    """The next due reports, out of their read texts (doc_id, text, error): trades, documents and the queue's new state."""
    due = queues.due(store.read("house_filing_stubs"), now, limit, review)
    stubs = trades.stubs_of(due)
    docs = stubs.join(texts, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source_url", "filing_date", "member_name", "error")
    results, rows = ptr.parse(docs, F.to_date(now))
    deals = trades.house_trades(stubs, results, rows)
    payload = trades.payload(deals)
    tries = docs.select("doc_id", "error").join(stubs.select("doc_id", "member_id"), "doc_id").join(results.select("doc_id", F.col("n_transactions").alias("trades"), F.col("parser_confidence").alias("confidence")), "doc_id", "left")
    queue = queues.with_outcome(store.read("house_filing_stubs"), tries, now)
    before = store.read("trades").count()
    after = _keep(store, "trades", "id", payload, now)
    found = documents.house_report(stubs, results.where("n_transactions > 0").withColumn("n", F.col("n_transactions")), deals)
    summary = {"processed": docs.count(), "trades": after - before, "indexed": index(store, found, now, embed)["documents"]}
    store.write("house_filing_stubs", queue)
    return summary | {"states": {r["status"]: r["n"] for r in store.read("house_filing_stubs").groupBy("status").agg(F.count("*").alias("n")).collect()}}


def ingest_senate(store: Store, rows: DataFrame, members: DataFrame, now: Column, start: str, limit: int = 0, embed: indexing.Embedder | None = None, watcher: bool = False) -> dict:
    """New Senate trades from a feed's rows, with their documents; none disclosed before ``start``."""
    all_ = (trades.watcher_trades if watcher else trades.bulk_trades)(rows, members)
    keyed = all_.withColumn("id", F.col("source_id"))
    new = trades.newest_first(queues.fresh(keyed, "id", store.read("trades"), "disclosure_date", start), limit=limit).drop("id")
    documents_ = documents.senate_trade(new, members)
    summary = {"feed": rows.count(), "normalized": all_.count(), "new": new.count()}
    summary["indexed"] = index(store, documents_, now, embed)["documents"]
    _keep(store, "trades", "id", trades.payload(new), now)
    return summary


def latest_disclosure(store: Store, *sources: str) -> str | None:
    """The high-water mark of a family of sources."""
    return store.read("trades").where(F.col("source").isin(*sources)).agg(F.max("disclosure_date")).first()[0]


def classify_asset(store: Store, ticker: str | None, description: str | None) -> dict:
    return store.spark.createDataFrame([(ticker, description)], "t string, d string").select(classify("t", "d").alias("c")).first()["c"].asDict()


def backfill_crypto(store: Store) -> dict:
    """Stored trades whose asset type or ticker the crypto rules would write otherwise, written so."""
    changes = trades.reclassified(store.read("trades"))
    kinds = {r["asset_type"]: r["n"] for r in changes.groupBy("asset_type").agg(F.count("*").alias("n")).collect()}
    store.write("trades", update_by_key(store.read("trades"), changes, "id", "asset_type", "ticker"))
    return {"updated": sum(kinds.values()), "kinds": kinds}


def ingest_offshore(store: Store, path: str, members: DataFrame, now: Column, limit: int = 0, with_links: bool = True, embed: indexing.Embedder | None = None) -> dict:
    nodes = offshore.nodes(feeds.offshore_nodes(store.spark, path, limit=limit))
    summary = {"nodes": _keep(store, "offshore_nodes", "node_key", nodes, now)}
    if with_links:
        summary["relationships"] = _keep(store, "offshore_relationships", "relationship_key", offshore.links(feeds.offshore_links(store.spark, path, limit)), now)
    found = matches.offshore(store.read("offshore_nodes"), members)
    summary["matches"] = _keep(store, "offshore_matches", "match_key", found, now)
    return summary | index(store, documents.offshore_match(store.read("offshore_matches"), store.read("offshore_nodes")), now, embed)


def ingest_fara(store: Store, registrants: DataFrame, principals: DataFrame, short_forms: DataFrame, filings: DataFrame, members: DataFrame, now: Column, offset: int = 0, limit: int = 0, embed: indexing.Embedder | None = None) -> dict:
    """Rows (maps) of the four kinds; a page of the registrants that aren't stored yet, with all that is theirs."""
    reg = fara.page(fara.registrants(registrants), offset, limit, store.read("fara_registrants"))
    mine = lambda df: df.join(reg.select("registration_number").distinct(), "registration_number", "left_semi")
    kinds = {"fara_foreign_principals": ("principal_key", mine(fara.principals(principals))), "fara_short_forms": ("short_form_key", mine(fara.short_forms(short_forms))), "fara_documents": ("document_key", mine(fara.documents(filings)))}
    found = matches.fara(reg, kinds["fara_foreign_principals"][1], kinds["fara_short_forms"][1], members)
    held = lambda name, *order: kinds[name][1].groupBy("registration_number").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("x"))
    lists = {"foreign_principals": held("fara_foreign_principals", "foreign_principal_name"), "short_forms": held("fara_short_forms", "full_name"), "documents": held("fara_documents", "date_stamped", "document_type", "url")}
    bundle = reg
    for name, df in lists.items():
        bundle = bundle.join(df.withColumnRenamed("x", name), "registration_number", "left").withColumn(name, F.coalesce(name, F.array().cast(df.schema["x"].dataType)))
    summary = index(store, documents.fara_registrant(bundle).unionByName(documents.fara_match(found, reg)), now, embed)
    for name, (key, rows) in kinds.items():
        summary[name] = _keep(store, name, key, rows, now)
    summary["fara_matches"] = _keep(store, "fara_matches", "match_key", found, now)
    return summary | {"fara_registrants": _keep(store, "fara_registrants", "registration_number", reg, now)}


def ingest_usaspending(store: Store, companies: DataFrame, results: DataFrame, awards: DataFrame, agencies: DataFrame, now: Column, embed: indexing.Embedder | None = None) -> dict:
    """Companies (company_id, company_name, ticker, query) with search results (query, RECIPIENT...): those that match well."""
    from .operators.match import LEAST, score

    scored = companies.join(results, "query").withColumns({"score": score("query", "name"), "seq": F.coalesce("recipient_id", F.lit(""))}).where(F.col("score") >= LEAST)
    best = pick_per_key(spending.best_recipients(scored), ["company_id"], F.desc("score"), F.desc(F.coalesce("amount", F.lit(0.0))), F.asc("recipient_id"))
    rec = spending.recipients(best.select("query", *results.drop("query").columns), F.col("query"))
    found = spending.company_matches(best.select("company_id", "company_name", "ticker", "recipient_id"), pick_per_key(rec, ["recipient_id"], F.asc("query_name")), awards, agencies)
    held = spending.award_records(found, awards)
    syncs = companies.join(best.select("company_id", F.lit("matched").alias("_s")), "company_id", "left").select("company_id", F.coalesce("_s", F.when(F.coalesce("query", F.lit("")) == "", "no_query").otherwise("no_match")).alias("status"), now.alias("synced_at"))
    summary = index(store, documents.spending_match(found, held), now, embed)
    for name, key, rows in (("usaspending_recipients", "recipient_id", rec), ("usaspending_company_matches", "match_key", found), ("usaspending_awards", "award_key", held), ("usaspending_company_syncs", "company_id", syncs)):
        summary[name] = _keep(store, name, key, rows, now)
    return summary


def sync_bills(store: Store, site: DataFrame, official: DataFrame, summaries: DataFrame, actions: DataFrame, now: Column, embed: indexing.Embedder | None = None) -> dict:
    """Bills of the site with what landed about them; summaries and actions have a bill_key."""
    s, a = legislation.summaries(summaries), legislation.actions(actions)
    b = legislation.bills(site, official, s, a)
    summary = index(store, documents.bill_context(b, s, a, site), now, embed)
    ok = official.select(F.col("site_bill_id").alias("bill_id")).distinct().withColumn("_ok", F.lit("ok"))
    syncs = site.select(F.col("id").cast("string").alias("bill_id")).join(ok, "bill_id", "left").select("bill_id", F.coalesce("_ok", F.lit("error")).alias("last_status"), now.alias("synced_at"))
    for name, key, rows in (("congress_bills", "bill_key", b), ("congress_bill_summaries", "summary_key", s), ("congress_bill_actions", "action_key", a), ("congress_bill_syncs", "bill_id", syncs)):
        summary[name] = _keep(store, name, key, rows, now)
    return summary


def index_site(store: Store, now: Column, site: str, name: str, embed: indexing.Embedder | None = None, members: DataFrame | None = None, **tables: DataFrame) -> dict:
    """Documents of the site's own tables, given by kind: story, dossier, member, committee, bill, alert."""
    made = []
    for kind, rows in tables.items():
        if kind == "story":
            made.append(documents.story(rows, documents.story_members(rows, members), site, name))
        else:
            made.append({"dossier": documents.dossier, "member": documents.member, "committee": documents.committee, "bill": documents.bill, "alert": documents.alert}[kind](rows, site, name))
    every = made[0]
    for m in made[1:]:
        every = every.unionByName(m)
    return index(store, every, now, embed)


def embed_backlog(store: Store, embed: indexing.Embedder | None, batch: int = 1000, most: int = 0, dim: int | None = None) -> dict:
    """Embeds what lacks a vector, batch by batch, each a new version of the chunks."""
    if dim is not None:
        check_vectors(store.read("search_chunks"), dim)

    def keep(df: DataFrame) -> DataFrame:
        store.write("search_chunks", df)
        return store.read("search_chunks")
    return indexing.drain(store.read("search_chunks"), embed, batch, most, keep)[1]


def hybrid_search(store: Store, query: str, vector: list[float] | None = None, limit: int = 10, **scope) -> DataFrame:
    """The best chunks for a query; by words only without a vector."""
    chunks = store.read("search_chunks")
    return search.hybrid(chunks, query, vector, limit, "id", "content", **scope)

"""Resolution, matching, documents, retrieval, store and streams over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.collections import cosine
from ..operators import match, ptr, search, store
from ..operators.chunk import chunk_rows
from ..operators.documents import Spec, build
from ..operators.relational import pick_per_key
from ..operators.resolve import resolve
from ..streaming import ingest
from .base import Tables, query
from .scalars import _NAMES, people

_M = f"m AS (SELECT c_custkey AS id, lower(strip_accents(first)) AS f, lower(strip_accents(last)) AS l, 'N' || c_nationkey AS st FROM {_NAMES})"


_PAIRS = """c AS (SELECT DISTINCT lower(p_name) AS n FROM part), r AS (SELECT DISTINCT lower(p_type || ' ' || p_name) AS n FROM part),
x AS (SELECT c.n AS company, r.n AS recipient, string_split(c.n, ' ') AS q, string_split(r.n, ' ') AS w FROM c, r),
s AS (SELECT company, recipient, len(q) AS k, len(list_filter(q, lambda t: list_contains(w, t))) AS h FROM x),
scored AS (SELECT company, recipient, CASE WHEN company = recipient THEN 100 WHEN k >= 2 AND h = k THEN 85 WHEN h >= 2 AND h / k >= 0.8 THEN 75 WHEN h >= 2 AND h / k >= 0.6 THEN 65 WHEN h = 1 AND k = 1 THEN 55 ELSE 0 END::BIGINT AS score FROM s WHERE h > 0)"""


def scored(t: Tables) -> DataFrame:
    """Pairs that share a word: no other pair can score."""
    c, r = t.part.select(F.lower("p_name").alias("company")).distinct(), t.part.select(F.lower(F.concat_ws(" ", "p_type", "p_name")).alias("recipient")).distinct()
    return match.candidates(c, r, "company", "recipient").withColumn("score", match.score("company", "recipient").cast("long"))


@query(f"WITH {_PAIRS} SELECT company, recipient, score FROM scored WHERE score >= 55")
def q34_match_score(t: Tables) -> DataFrame:
    return scored(t).where("score >= 55")


@query(f"WITH {_PAIRS} SELECT DISTINCT ON (recipient) recipient, company, score FROM scored WHERE score >= 55 ORDER BY recipient, score DESC, company")
def q35_best_candidate(t: Tables) -> DataFrame:
    return pick_per_key(scored(t).where("score >= 55"), ["recipient"], F.desc("score"), F.asc("company"))


@query("""SELECT 'doc-order:' || o_orderkey AS id, 'Order ' || o_orderkey AS title, concat_ws(chr(10), 'Customer: ' || c_name, CASE WHEN o_orderstatus <> 'P' THEN 'Status: ' || o_orderstatus END, 'Priority: ' || o_orderpriority) AS content,
CASE WHEN c_mktsegment = 'BUILDING' THEN 'order,BUILDING' ELSE 'order' END AS tags, 'order:' || o_orderkey AS source_document_id FROM orders JOIN customer ON c_custkey = o_custkey""")
def q36_build_documents(t: Tables) -> DataFrame:
    spec = Spec("order", "trade", "o_orderkey", "concat('Order ', o_orderkey)", [("Customer", "c_name"), ("Status", "nullif(o_orderstatus, 'P')"), ("Priority", "o_orderpriority")], ["'order'", "if(c_mktsegment = 'BUILDING', c_mktsegment, '')"], {"member_ids": "c_custkey"}, {"status": "o_orderstatus"})
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return build(rows, spec).select("id", "title", "content", F.array_join("tags", ",").alias("tags"), "source_document_id")


@query(r"""WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: CASE WHEN length(regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '')) >= 3 THEN regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '') ELSE w END) AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, len(list_filter(w, lambda x: x = 'heron')) AS a, len(list_filter(w, lambda x: x = 'than')) AS b, len(list_filter(w, lambda x: x = 'whose')) AS no FROM d)
SELECT doc_id, (a + b)::DOUBLE AS lexical_score FROM c WHERE a + b > 0 AND no = 0 ORDER BY lexical_score DESC, doc_id LIMIT 100""")
def q38_lexical_search(t: Tables) -> DataFrame:
    return search.lexical(t.documents.select("doc_id", "text"), "heron or than -whose", 100, "doc_id", "text").select("doc_id", "lexical_score")


def _query_vector(t: Tables) -> list[float]:
    return [float(x) for x in t.embeddings.where("vec_id = 0").first()["embedding"]]


@query("""SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e, embeddings q WHERE q.vec_id = 0 ORDER BY score DESC, e.vec_id LIMIT 50""")
def q39_vector_topk(t: Tables) -> DataFrame:
    q = F.array(*map(F.lit, _query_vector(t)))
    return t.embeddings.select("vec_id", F.round(cosine(F.col("embedding"), q), 6).alias("score")).orderBy(F.desc("score"), "vec_id").limit(50)


_HYBRID = r"""WITH d AS (SELECT doc_id, lang, len(list_filter(list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda w: CASE WHEN length(regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '')) >= 3 THEN regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '') ELSE w END), lambda x: x = 'than'))::DOUBLE AS lex FROM documents),
c AS (SELECT doc_id, lex, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS s FROM d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN embeddings q ON q.vec_id = 0 {0}),
r AS (SELECT doc_id, lex, s, round(0.45::DOUBLE * lex + 0.55::DOUBLE * {1}, 6) AS combined FROM c WHERE lex > 0 OR s IS NOT NULL)
SELECT doc_id, lex AS lexical_score, coalesce(s, 0) AS semantic_score, coalesce(combined, 0) AS combined_score FROM (SELECT * FROM r ORDER BY combined DESC NULLS FIRST, doc_id LIMIT 100)"""


def _hybrid(t: Tables, **how) -> DataFrame:
    docs = t.documents.select("doc_id", "text", "lang").join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left")
    return search.hybrid(docs, "than", _query_vector(t), 100, "doc_id", "text", **how)


@query(_HYBRID.format("", "coalesce(s, 0)"))
def q40_hybrid(t: Tables) -> DataFrame:
    return _hybrid(t)


@query(_HYBRID.format("", "s"))
def q41_hybrid_null_order(t: Tables) -> DataFrame:
    return _hybrid(t, nulls_first=True)


@query(_HYBRID.format("WHERE d.lang = 'en'", "coalesce(s, 0)"))
def q42_scoped_search(t: Tables) -> DataFrame:
    return _hybrid(t, lang="en")


@query("SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)")
def q43_embedding_queue(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "n_chars").join(t.embeddings.select("vec_id"), F.col("doc_id") == F.col("vec_id"), "left_anti")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS digest, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text")
def q44_exact_dup_docs(t: Tables) -> DataFrame:
    """Texts meet by digest and length, so they aren't shuffled."""
    d = t.documents.where("text is not null").select("doc_id", F.md5("text").alias("digest"), F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    return d.groupBy("digest", "h", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "digest", "copies")


@query("""SELECT l_orderkey, l_partkey, 'old' AS batch FROM lineitem WHERE l_quantity < 25 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT l_orderkey, l_partkey, 'new' FROM lineitem WHERE l_quantity >= 25 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def q47_replace_children(t: Tables) -> DataFrame:
    parents = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = lambda name, where: t.lineitem.where(where).select("l_orderkey", "l_partkey", F.lit(name).alias("batch"))
    return store.replace_children(rows("old", "l_quantity < 25"), rows("new", "l_quantity >= 25").join(parents, "l_orderkey", "left_semi"), parents, "l_orderkey")


@query("""WITH d AS (SELECT *, event_type = 'error' AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.user_id) AS gone FROM events e) SELECT event_type, count(*) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone) AS removed FROM d GROUP BY 1""")
def q48_prune(t: Tables) -> DataFrame:
    kept, gone = store.prune(t.events, F.col("event_type") == "error", t.orders.select(F.col("o_custkey").alias("user_id")), "user_id")
    both = kept.select("event_type", F.lit(1).alias("k")).unionByName(gone.select("event_type", F.lit(0).alias("k")))
    return both.groupBy("event_type").agg(F.sum("k").alias("kept"), F.sum(1 - F.col("k")).alias("removed"))


@query("""SELECT date_trunc('day', ts)::TIMESTAMPTZ AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT DISTINCT ON (event_id) * FROM events ORDER BY event_id) GROUP BY 1, 2""")
def q49_stream_dedupe_windows(t: Tables) -> DataFrame:
    """As a stream run to its end."""
    return ingest.drain(ingest.windowed_counts(ingest.event_stream(t.spark, t.path("events"))), ["start", "event_type"])


@query("""SELECT DISTINCT l_orderkey AS doc_id, 'T' || l_partkey % 10 AS ignored, strftime(l_shipdate, '%Y-%m-%d') AS transaction_date, CASE l_returnflag WHEN 'R' THEN 'sale' WHEN 'A' THEN 'exchange' ELSE 'purchase' END AS transaction_type, 15001::BIGINT AS amount_min, 50000::BIGINT AS amount_max FROM lineitem WHERE l_shipdate IS NOT NULL""".replace("'T' || l_partkey % 10 AS ignored, ", "'Acme' || chr((65 + l_partkey % 10)::INT) || ' Corp' AS asset_description, "))
def q52_ptr_parse(t: Tables) -> DataFrame:
    return _reports(t)[1].select("doc_id", "asset_description", "transaction_date", "transaction_type", "amount_min", "amount_max")


_CUT = "(SELECT min(ts)::DATE + ((max(ts)::DATE - min(ts)::DATE + 1) // 2)::INT FROM events)"


def _batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All events in two batches: those before the middle of the days covered, and the rest."""
    cut = t.events.agg(F.expr("date_add(min(ts), cast(floor((datediff(max(ts), min(ts)) + 1) / 2) as int)) AS cut")).first()["cut"]
    early = F.coalesce(F.col("ts") < F.lit(cut), F.lit(False))
    return t.events.where(early), t.events.where(~early)


@query(f"""WITH b AS (SELECT user_id, event_id, value, coalesce(ts < {_CUT}, false) AS early FROM events), o AS (SELECT DISTINCT ON (user_id) user_id, value FROM b WHERE early ORDER BY user_id, event_id DESC),
n AS (SELECT DISTINCT ON (user_id) user_id, value FROM b WHERE NOT early ORDER BY user_id, event_id DESC)
SELECT user_id, CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE o.value END AS value, CASE WHEN o.user_id IS NOT NULL THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS created_at, CASE WHEN n.user_id IS NOT NULL THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS updated_at FROM o FULL JOIN n USING (user_id)""")
def q45_upsert(t: Tables) -> DataFrame:
    """Every event, in two batches by time, under its user."""
    day = lambda x: F.to_date(F.lit(x))
    early, late = (b.select("user_id", F.col("event_id").alias("seq"), "value") for b in _batches(t))
    empty = early.where("false").select("user_id", "value", day("2024-01-01").alias("created_at"), day("2024-01-01").alias("updated_at"))
    return store.upsert(store.upsert(empty, early, ["user_id"], "seq", day("2024-01-01")), late, ["user_id"], "seq", day("2024-02-01"))


@query(f"""WITH b AS (SELECT *, coalesce(ts < {_CUT}, false) AS early FROM events), o AS (SELECT user_id, arg_max(event_type, event_id) AS e, count(*) AS c FROM b WHERE early GROUP BY 1), n AS (SELECT user_id, count(*) AS c FROM b WHERE NOT early GROUP BY 1)
SELECT user_id, CASE WHEN n.user_id IS NULL OR o.e IN ('purchase', 'click') THEN o.e ELSE 'pending_extraction' END AS status, o.c::VARCHAR AS old, n.c::VARCHAR AS new FROM o FULL JOIN n USING (user_id)""")
def q46_upsert_conditional(t: Tables) -> DataFrame:
    meta = lambda name: F.to_json(F.create_map(F.lit(name), F.count("*").cast("string"))).alias("metadata")
    early, late = _batches(t)
    got = store.sync_queue(early.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("status"), meta("old")), late.groupBy("user_id").agg(meta("new")), "user_id", held=("purchase", "click"))
    return got.select("user_id", "status", F.get_json_object("metadata", "$.old").alias("old"), F.get_json_object("metadata", "$.new").alias("new"))


def _registry(t: Tables) -> DataFrame:
    return people(t).select(F.col("c_custkey").alias("id"), F.concat(F.lit("B"), F.col("c_custkey")).alias("bioguide_id"), F.concat_ws(" ", "first", "last").alias("name"), F.concat(F.lit("N"), F.col("c_nationkey")).alias("state"))


_CUTS = "list_transform(range(0, greatest(0, ceil((length(q) - 3200) / 2400.0))::BIGINT + 1), lambda i: trim(substr(q, i * 2400 + 1, 3200), E' \\t\\n\\r'))"


@query(rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_split_to_array(trim(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'), E' \t\n\r'), '\n\s*\n') AS raw FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, list_filter(list_transform(raw, lambda x: trim(x, E' \t\n\r')), lambda x: x <> '') AS ps FROM d),
r AS (SELECT doc_id, 1 AS i, '' AS cur, []::VARCHAR[] AS done FROM p WHERE len(ps) > 0
UNION ALL SELECT doc_id, i + 1, CASE WHEN length(cand) <= 3200 THEN cand WHEN length(q) <= 3200 THEN q ELSE '' END,
CASE WHEN length(cand) <= 3200 THEN done ELSE done || CASE WHEN cur <> '' THEN [cur] ELSE []::VARCHAR[] END || CASE WHEN length(q) > 3200 THEN {_CUTS} ELSE []::VARCHAR[] END END
FROM (SELECT r.*, ps[i] AS q, CASE WHEN cur = '' THEN ps[i] ELSE cur || chr(10) || chr(10) || ps[i] END AS cand FROM r JOIN p USING (doc_id) WHERE i <= len(ps))),
f AS (SELECT doc_id, list_filter(CASE WHEN cur <> '' THEN done || [cur] ELSE done END, lambda x: x <> '') AS cs FROM r JOIN p USING (doc_id) WHERE i = len(ps) + 1)
SELECT doc_id, i - 1 AS chunk_index, cs[i] AS content FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM f)""")
def q37_chunk(t: Tables) -> DataFrame:
    """Every document, with or without paragraphs."""
    return chunk_rows(t.documents, "doc_id", "text").select(F.col("document_id").alias("doc_id"), F.col("chunk_index").cast("long").alias("chunk_index"), "content")


def _resolved(rows: str) -> str:
    """SQL that resolves ``rows`` (row_id, nm, st, bio): a bioguide id alone, else by key, else by beginnings."""
    return f"""WITH {_M}, r AS ({rows}), w AS (SELECT *, string_split(nm, ' ')[1] AS a, string_split(nm, ' ')[-1] AS z, contains(nm, ' ') AS two FROM r WHERE bio IS NULL AND nm <> ''),
k AS (SELECT id, st, unnest([f || ' ' || l, f || ' ' || l || '|' || st, l, l || '|' || st]) AS key FROM m),
a AS (SELECT key, count(*) AS n, min(id) AS one FROM k GROUP BY 1), i AS (SELECT key, st, count(*) AS n, min(id) AS one FROM k GROUP BY 1, 2),
t AS (SELECT row_id, st, unnest([nm, CASE WHEN st <> '' THEN nm || '|' || st END, CASE WHEN two THEN a || ' ' || z END, CASE WHEN two AND st <> '' THEN a || ' ' || z || '|' || st END, CASE WHEN two THEN z END, CASE WHEN two AND st <> '' THEN z || '|' || st END]) AS key, unnest([1, 2, 3, 4, 5, 6]) AS pos FROM w),
p AS (SELECT row_id, pos, key, CASE WHEN t.st <> '' AND i.n IS NOT NULL THEN CASE WHEN i.n = 1 THEN i.one END WHEN a.n = 1 THEN a.one END AS member_id FROM t JOIN a USING (key) LEFT JOIN i USING (key, st)),
b AS (SELECT row_id, arg_min(member_id, pos) AS member_id, arg_min(key, pos) AS matched_key, 'key' AS matched_kind FROM p WHERE member_id IS NOT NULL GROUP BY 1),
o AS (SELECT DISTINCT nm, st FROM w ANTI JOIN b USING (row_id)),
x AS (SELECT o.nm, o.st, count(*) AS n, min(m.id) AS one FROM o JOIN m ON (o.st = '' OR o.st = m.st) AND (m.f || m.l = replace(o.nm, ' ', '') OR starts_with(m.f || ' ' || m.l, o.nm) OR starts_with(o.nm, m.f || ' ' || m.l)) GROUP BY 1, 2),
every AS (SELECT * FROM b UNION ALL SELECT w.row_id, x.one, NULL, 'prefix' FROM w ANTI JOIN b USING (row_id) JOIN x ON x.nm = w.nm AND x.st = w.st AND x.n = 1 UNION ALL SELECT r.row_id, m.id, r.bio, 'bioguide' FROM r JOIN m ON r.bio = 'B' || m.id)
SELECT r.row_id, every.member_id, every.matched_key, every.matched_kind FROM r LEFT JOIN every USING (row_id)"""


@query(_resolved("""SELECT o_orderkey AS row_id, CASE o_orderkey % 3 WHEN 0 THEN m.f || ' ' || m.l ELSE 'x ' || m.l END AS nm, CASE o_orderkey % 2 WHEN 0 THEN m.st ELSE '' END AS st,
CASE WHEN o_orderkey % 5 = 0 THEN 'B' || m.id WHEN o_orderkey % 7 = 0 THEN 'Z0' END AS bio FROM orders JOIN m ON m.id = o_custkey"""))
def q32_resolve_members(t: Tables) -> DataFrame:
    """Every row of a resolution, whatever it was resolved by; some rows have a bioguide id, known or not."""
    members, k = _registry(t), F.col("o_orderkey")
    named = F.when(k % 3 == 0, F.concat(F.lit("Sen. "), F.upper("name"), F.lit(", Jr."))).otherwise(F.concat(F.lit("X. "), F.element_at(F.split("name", " "), -1)))
    rows = t.orders.select("o_orderkey", "o_custkey").join(members, F.col("o_custkey") == F.col("id"))
    rows = rows.select(k.alias("row_id"), named.alias("name"), F.when(k % 2 == 0, F.lower("state")).alias("state"), F.when(k % 5 == 0, F.lower("bioguide_id")).when(k % 7 == 0, "Z0").alias("bioguide"))
    return resolve(rows, members, bioguide="bioguide")


@query(_resolved("SELECT id AS row_id, CASE id % 3 WHEN 0 THEN left(f || ' ' || l, length(f || ' ' || l) - 1) WHEN 1 THEN f || l ELSE f || ' ' || l || 'x' END AS nm, st, NULL AS bio FROM m"))
def q33_prefix_fallback(t: Tables) -> DataFrame:
    """Names that no key finds: cut short, written in one, or longer than the registry's; all with a state."""
    members, k = _registry(t), F.col("id") % 3
    name = F.when(k == 0, F.expr("left(name, length(name) - 1)")).when(k == 1, F.replace("name", F.lit(" "), F.lit(""))).otherwise(F.concat("name", F.lit("x")))
    return resolve(members.select(F.col("id").alias("row_id"), name.alias("name"), "state"), members)


def _reports(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Results and transactions of reports written from line items and parsed again; days that are missing stay blank."""
    d, k = F.date_format("l_shipdate", "M/d/yyyy"), F.chr((F.lit(65) + F.col("l_partkey") % 10).cast("long"))
    line = F.concat(F.lit("SP Acme"), k, F.lit(" Corp (AC"), k, F.lit(") [ST] "), F.when(F.col("l_returnflag") == "R", "S (partial)").when(F.col("l_returnflag") == "A", "E").otherwise("P"), F.lit(" "), d, F.lit(" "), d, F.lit(" SP $15,001 - $50,000"))
    docs = t.lineitem.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.array_join(F.array_sort(F.collect_list(line)), " • ").alias("text"))
    docs = docs.withColumns({"source_url": F.lit("https://example.org/ptr"), "filing_date": F.lit("2030-01-01"), "member_name": F.when(F.col("doc_id") % 2 == 0, "A Member")})
    return ptr.parse(docs, F.to_date(F.lit("2031-01-01")))


@query("""WITH d AS (SELECT DISTINCT l_orderkey, l_partkey % 10, l_shipdate, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END FROM lineitem WHERE l_shipdate IS NOT NULL), c AS (SELECT l_orderkey, count(*) AS n FROM d GROUP BY 1),
o AS (SELECT DISTINCT l_orderkey AS doc_id, CASE l_orderkey % 2 WHEN 0 THEN 'A Member' END AS member_name FROM lineitem)
SELECT doc_id, member_name, coalesce(n, 0) AS n_transactions, CASE WHEN n IS NULL THEN 0 ELSE least(0.95, round_even(0.35::DOUBLE + CASE WHEN member_name IS NULL THEN 0 ELSE 0.25 END::DOUBLE + least(0.2, n * 0.05)::DOUBLE + least(0.15, n * 0.04)::DOUBLE + least(0.1, n * 0.03)::DOUBLE, 2)) END::DOUBLE AS parser_confidence FROM o LEFT JOIN c ON l_orderkey = doc_id""")
def q61_ptr_results(t: Tables) -> DataFrame:
    return _reports(t)[0].select("doc_id", "member_name", "n_transactions", "parser_confidence")


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type = 'purchase' AS ok, event_type = 'error' AND event_id % 2 = 0 AS again, event_type <> 'purchase' AND (event_type <> 'error' OR event_id % 2 = 1) AS review FROM events)
SELECT user_id, CASE WHEN bool_or(ok) THEN 'parsed' WHEN arg_max(again, (ts, event_id)) THEN 'pending_extraction' ELSE 'needs_review' END AS status, count(*) FILTER (WHERE again) AS retries, count(*) AS attempts FROM e GROUP BY 1""")
def q50_queue_state_machine(t: Tables) -> DataFrame:
    """Events as the outcomes of extractions: purchases give trades, every other error may pass."""
    kind = F.col("event_type")
    tries = ingest.event_stream(t.spark, t.path("events")).select("user_id", "ts", "event_id", (kind == "purchase").cast("int").alias("trades"), F.lit("m").alias("member_id"), F.lit(0.8).alias("confidence"),
                                                                   F.when(kind == "error", F.when(F.col("event_id") % 2 == 0, "read timed out").otherwise("not a PDF")).alias("error"))
    return ingest.drain(ingest.queue_states(tries), ["user_id"])


@query(r"""WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'), lambda w: CASE WHEN length(regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '')) >= 3 THEN regexp_replace(w, '(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$', '') ELSE w END) AS w FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, len(list_filter(w, lambda x: x = 'heron')) AS a, len(list_filter(w, lambda x: x = 'than')) AS b, len(list_filter(w, lambda x: x = 'whose')) AS no FROM d)
SELECT doc_id, (a + b)::DOUBLE AS lexical_score FROM c WHERE a + b > 0 AND no = 0 """)
def q62_indexed_search(t: Tables) -> DataFrame:
    """q38's hits, all of them, out of an inverted table."""
    return search.indexed(search.inverted(t.documents.select("doc_id", "text"), "doc_id", "text"), "heron or than -whose", key="doc_id")

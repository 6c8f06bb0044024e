"""Joins, aggregates, picks, orders and set operations over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.collections import count_map, ordered_list
from ..functions.dates import stale
from ..operators.relational import bundle, lookup_members, only_missing, or_activity, pick_per_key, status_counts
from .base import Tables, query

AS_OF = "2000-06-30"
_BLANK = "(l_linenumber = 7 AND l_quantity >= 45)"


def trades(t: Tables) -> DataFrame:
    """Line items as trades: some lack the company's id and have only its ticker."""
    blank = F.expr(_BLANK)
    rows = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.when(~blank, F.col("l_partkey")).alias("company_id"), F.concat(F.lit("brand#"), F.col("l_suppkey") % 25 + 1).alias("ticker"), F.coalesce("l_shipdate", "o_orderdate").alias("happened"))


@query(f"""WITH t AS (SELECT CASE WHEN NOT {_BLANK} THEN l_partkey END AS company_id, upper('brand#' || (l_suppkey % 25 + 1)) AS ticker, coalesce(l_shipdate, o_orderdate) AS happened
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT p_partkey AS company_id, p_name AS name, count(*) AS trade_count, max(happened) AS latest FROM part JOIN t ON t.company_id = p_partkey OR (t.company_id IS NULL AND t.ticker = upper(p_brand))
GROUP BY ALL ORDER BY trade_count DESC, latest DESC NULLS LAST, name, company_id LIMIT 500""")
def q01_company_activity(t: Tables) -> DataFrame:
    c = t.part.select(F.col("p_partkey").alias("company_id"), F.col("p_name").alias("name"), F.upper("p_brand").alias("ticker"))
    act = or_activity(c, trades(t).withColumn("ticker", F.upper("ticker")), "company_id", "ticker", "happened")
    return act.select("company_id", "name", "trade_count", "latest").orderBy(F.desc("trade_count"), F.desc_nulls_last("latest"), "name", "company_id").limit(500)


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC NULLS LAST, o_orderkey DESC")
def q02_latest_per_key(t: Tables) -> DataFrame:
    return pick_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], F.desc_nulls_last("o_orderdate"), F.desc("o_orderkey"))


@query("""WITH c AS (SELECT o_custkey, upper(o_orderpriority) AS ticker, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, ticker, n FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, ticker) <= 2""")
def q03_topk_per_group(t: Tables) -> DataFrame:
    n = t.orders.groupBy("o_custkey", F.upper("o_orderpriority").alias("ticker")).agg(F.count("*").alias("n"))
    return pick_per_key(n, ["o_custkey"], F.desc("n"), F.asc("ticker"), n=2)


@query("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE 'doc-' || l.doc_id = 'doc-' || d.doc_id)")
def q04_only_missing(t: Tables) -> DataFrame:
    known = t.labels.select(F.concat(F.lit("doc-"), F.col("doc_id")).alias("source_document_id"))
    return only_missing(t.documents.select("doc_id", "source"), F.concat(F.lit("doc-"), F.col("doc_id")), known, "source_document_id")


@query("""SELECT o_orderkey, o_orderstatus, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q05_left_sponsor(t: Tables) -> DataFrame:
    c = t.customer.where("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "o_orderstatus", "c_name", "n_name")


@query("""WITH r AS (SELECT c_nationkey, c_name, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 2 END AS k, c_custkey FROM customer),
top AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY k, c_name, c_custkey) <= 40)
SELECT n_name, coalesce(string_agg(c_name, '|' ORDER BY k, c_name, c_custkey), '') AS members FROM nation LEFT JOIN top ON n_nationkey = c_nationkey GROUP BY n_name""")
def q06_members_with_nested(t: Tables) -> DataFrame:
    """Committees with their 40 first members by role, then name."""
    rank = F.when(F.col("c_mktsegment") == "BUILDING", 0).when(F.col("c_mktsegment") == "MACHINERY", 1).otherwise(2)
    top = pick_per_key(t.customer.withColumn("k", rank), ["c_nationkey"], F.asc("k"), F.asc("c_name"), F.asc("c_custkey"), n=40)
    lists = top.groupBy("c_nationkey").agg(F.array_join(ordered_list(F.col("c_name"), F.col("k"), F.col("c_name"), F.col("c_custkey")), "|").alias("members"))
    return t.nation.join(lists, F.col("n_nationkey") == F.col("c_nationkey"), "left").select("n_name", F.coalesce("members", F.lit("")).alias("members"))


@query("""SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (WHERE role = 'user'), '') AS asked, count(*) AS turns FROM conversations GROUP BY conv_id""")
def q07_ordered_nested_agg(t: Tables) -> DataFrame:
    user = ordered_list(F.col("text"), F.col("turn"), F.col("text"), where=F.col("role") == "user")
    return t.conversations.groupBy("conv_id").agg(F.array_join(user, "\n").alias("asked"), F.count("*").alias("turns"))


@query("""WITH a AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'),
h AS (SELECT DISTINCT o_custkey, upper(p_brand) AS b FROM a JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)
SELECT o_custkey, n_orders, coalesce(brands, '') AS brands FROM (SELECT o_custkey, count(*) AS n_orders FROM a GROUP BY 1) LEFT JOIN (SELECT o_custkey, string_agg(b, ',' ORDER BY b) AS brands FROM h GROUP BY 1) USING (o_custkey)""")
def q08_array_membership(t: Tables) -> DataFrame:
    alerts = t.orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("ids"))
    items = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return lookup_members(alerts, "o_custkey", "ids", items, "l_orderkey", F.upper("p_brand"), "brands").select("o_custkey", F.size("ids").cast("long").alias("n_orders"), F.array_join("brands", ",").alias("brands"))


@query("""SELECT s_suppkey, s_name, coalesce(a, '') AS parts, coalesce(b, '') AS returns FROM supplier
LEFT JOIN (SELECT l_suppkey, string_agg(x, ',' ORDER BY x) AS a FROM (SELECT DISTINCT l_suppkey, l_partkey AS x FROM lineitem) GROUP BY 1) p ON p.l_suppkey = s_suppkey
LEFT JOIN (SELECT l_suppkey, string_agg(x, ',' ORDER BY x) AS b FROM (SELECT DISTINCT l_suppkey, l_orderkey AS x FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1) r ON r.l_suppkey = s_suppkey""")
def q09_bundle_children(t: Tables) -> DataFrame:
    a = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("x")).distinct()
    b = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_orderkey").alias("x")).distinct()
    got = bundle(t.supplier, "s_suppkey", parts=a, returns=b)
    return got.select("s_suppkey", "s_name", F.array_join("parts.x", ",").alias("parts"), F.array_join("returns.x", ",").alias("returns"))


@query("""SELECT 'documents' AS counter, count(*) AS n FROM documents UNION ALL SELECT 'long', count(*) FROM documents WHERE n_chars > 3200 UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'vectors', count(*) FROM embeddings UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1""")
def q10_status_snapshot(t: Tables) -> DataFrame:
    return status_counts(documents={"long": F.col("n_chars") > 3200}, orders={"open": F.col("o_orderstatus") == "O"}, events={"errors": F.col("event_type") == "error"}, vectors={}, pages={}, labels={"toxic": F.col("toxic") == 1},
                         tables={"documents": t.documents, "orders": t.orders, "events": t.events, "vectors": t.embeddings, "pages": t.pages, "labels": t.labels}).where("counter <> 'labels'")


@query("""SELECT lang, '{' || string_agg('"' || source || '":' || n, ',' ORDER BY source) || '}' AS by_source FROM (SELECT lang, coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang""")
def q11_count_map_json(t: Tables) -> DataFrame:
    n = t.documents.groupBy("lang", F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    return n.groupBy("lang").agg(count_map(F.col("source"), F.col("n")).alias("by_source"))


@query("SELECT event_type, max(CAST(ts AS DATE)) AS latest, count(*) AS n FROM events GROUP BY event_type")
def q12_max_watermark(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.max(F.to_date("ts")).alias("latest"), F.count("*").alias("n"))


@query("""WITH c AS (SELECT l_suppkey, p_brand, count(*) AS n, min(l_orderkey) AS first FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT l_suppkey, p_brand, n, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, first, p_brand) AS place FROM c QUALIFY place <= 5""")
def q13_most_common_k(t: Tables) -> DataFrame:
    n = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey", "p_brand").agg(F.count("*").alias("n"), F.min("l_orderkey").alias("first"))
    w = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(F.desc("n"), "first", "p_brand"))
    return n.withColumn("place", w.cast("long")).where("place <= 5").select("l_suppkey", "p_brand", "n", "place")


@query(f"""SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate IS NULL OR o_orderstatus = 'P' OR o_orderdate < TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY
ORDER BY coalesce(o_orderdate, TIMESTAMP '1970-01-01'), o_totalprice DESC NULLS LAST, o_orderkey LIMIT 1000""")
def q14_stale_candidates(t: Tables) -> DataFrame:
    now = F.lit(AS_OF).cast("timestamp_ntz")
    due = t.orders.where(stale("o_orderdate", "o_orderstatus", now, 365, ("P",)))
    return due.orderBy(F.coalesce("o_orderdate", F.lit("1970-01-01").cast("timestamp_ntz")), F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(1000).select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("""SELECT event_id, event_type, ts FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 20 ORDER BY CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts DESC, event_id LIMIT 200""")
def q15_queue_order(t: Tables) -> DataFrame:
    rank = F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    return t.events.where(F.get_json_object("props", "$.k").try_cast("long") >= 20).orderBy(rank, F.desc("ts"), "event_id").limit(200).select("event_id", "event_type", "ts")


@query("""SELECT p_partkey, p_name FROM part WHERE coalesce(trim(p_name), '') <> '' AND p_type IN ('ECONOMY', 'PROMO') AND regexp_matches(p_name, 'RING|bolt', 'i') AND p_brand <> 'Brand#1'""")
def q16_blank_safe_filter(t: Tables) -> DataFrame:
    return t.part.where((F.coalesce(F.trim("p_name"), F.lit("")) != "") & F.col("p_type").isin("ECONOMY", "PROMO") & F.col("p_name").rlike("(?i)RING|bolt") & (F.col("p_brand") != "Brand#1")).select("p_partkey", "p_name")


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""")
def q17_union_sources(t: Tables) -> DataFrame:
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("""SELECT 'both' AS side, k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders) UNION ALL SELECT 'new', k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'any', k FROM (SELECT s_suppkey AS k FROM supplier UNION SELECT n_nationkey FROM nation)""")
def q18_set_ops(t: Tables) -> DataFrame:
    c, o = t.customer.select(F.col("c_custkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k"))
    any_ = t.supplier.select(F.col("s_suppkey").alias("k")).union(t.nation.select(F.col("n_nationkey").cast("long"))).distinct()
    side = lambda name, df: df.select(F.lit(name).alias("side"), "k")
    return side("both", c.intersect(o)).union(side("new", c.join(o, "k", "left_anti").distinct())).union(side("any", any_))


@query("""WITH e AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
deg AS (SELECT s, count(*) AS degree FROM e GROUP BY s)
SELECT e.c AS customer, count(*) AS links, sum(degree - 1)::BIGINT AS two_hop FROM e JOIN deg USING (s) GROUP BY e.c""")
def q54_graph_edges(t: Tables) -> DataFrame:
    """Degrees, and paths of two edges to other customers, from degrees alone: no path is made."""
    e = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("customer"), F.col("l_suppkey").alias("s")).distinct()
    return e.join(e.groupBy("s").agg(F.count("*").alias("degree")), "s").groupBy("customer").agg(F.count("*").alias("links"), F.sum(F.col("degree") - 1).alias("two_hop"))

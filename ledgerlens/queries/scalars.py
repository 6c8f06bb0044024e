"""Text, money, dates, hashes, JSON and rules over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.collections import json_text, merge_json
from ..functions.dates import fara_date, feed_date, iso_from_us, reconcile_dates, senate_date
from ..functions.hashing import sha1_key, sha256_key
from ..functions.money import bracket, parse_range
from ..functions.text import html_to_text, lookup_keys, normalize_name, split_multi, squeeze, strip_accents, text_confidence, token_estimate
from ..operators.fara import PRINCIPAL, repair_principals
from ..rules.crypto import classify
from .base import Tables, query

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(rf"SELECT doc_id, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS text FROM documents")
def q19_squeeze_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", squeeze("text").alias("text"))


@query("SELECT doc_id, strip_accents(text) AS text FROM documents")
def q21_strip_accents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", strip_accents("text").alias("text"))


_NAMES = "(SELECT c_custkey, c_nationkey, ['Tomás', 'Zoë', 'Ana', 'Björn', 'Lucía', 'Noah', 'Ida'][c_custkey % 7 + 1] AS first, ['Sánchez', 'Keane', 'Müller', 'Ostrow', 'Hale', 'Brandt', 'Peña', 'Quist', 'Rowe', 'Vance', 'Whit'][c_custkey % 11 + 1] || chr((97 + c_custkey // 77 % 26)::INT) || chr((97 + c_custkey // 2002 % 26)::INT) AS last FROM customer)"


def people(t: Tables) -> DataFrame:
    """Customers with names made from their keys."""
    k = F.col("c_custkey")
    pick = lambda n, *names: F.element_at(F.array(*map(F.lit, names)), (k % n + 1).cast("int"))
    letter = lambda d: F.chr((F.lit(97) + F.floor(k / d) % 26).cast("long"))
    last = F.concat(pick(11, "Sánchez", "Keane", "Müller", "Ostrow", "Hale", "Brandt", "Peña", "Quist", "Rowe", "Vance", "Whit"), letter(77), letter(2002))
    return t.customer.select("c_custkey", "c_nationkey", pick(7, "Tomás", "Zoë", "Ana", "Björn", "Lucía", "Noah", "Ida").alias("first"), last.alias("last"))


@query(f"SELECT c_custkey, lower(strip_accents(first || ' ' || last)) AS name FROM {_NAMES}")
def q21_normalize_name(t: Tables) -> DataFrame:
    return people(t).select("c_custkey", normalize_name(F.concat(F.lit("  Rep. "), F.upper("first"), F.lit(" \t"), F.col("last"), F.lit(", Jr."))).alias("name"))


@query(f"""WITH n AS (SELECT c_custkey, lower(strip_accents(first || ' ' || last)) AS f, lower(strip_accents(last)) AS l, 'N' || c_nationkey AS st FROM {_NAMES}),
k AS (SELECT c_custkey, [f, f || '|' || st, l, l || '|' || st] AS keys FROM n)
SELECT c_custkey, i - 1 AS pos, keys[i] AS key FROM k, unnest(range(1, 5)) u(i)""")
def q22_lookup_keys(t: Tables) -> DataFrame:
    keys = lookup_keys(F.concat_ws(" ", "first", "last"), "first", "last", F.concat(F.lit("n"), F.col("c_nationkey")))
    spread = people(t).repartition("c_custkey")  # few bytes and much work: a file's row groups would give few tasks
    return spread.select("c_custkey", F.posexplode(keys).alias("pos", "key")).withColumn("pos", F.col("pos").cast("long"))


_B = [0, 1_000, 15_000, 50_000, 100_000, 250_000, 500_000, 1_000_000, 5_000_000, 25_000_000, 50_000_000]


def _bracket_sql(end: str) -> str:
    return "CASE WHEN o_totalprice IS NULL OR o_totalprice < 1001 THEN 0 " + " ".join(f"WHEN o_totalprice <= {hi} THEN {lo + 1 if end == 'low' else hi}" for lo, hi in zip(_B[1:], _B[2:])) + f" ELSE {_B[-1] + 1 if end == 'low' else 2 * _B[-1]} END::BIGINT"


@query(f"SELECT o_orderkey, {_bracket_sql('low')} AS low, {_bracket_sql('high')} AS high FROM orders")
def q23_amount_bucket(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", bracket("o_totalprice").alias("b")).select("o_orderkey", "b.low", "b.high")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 0 ELSE floor(o_totalprice)::BIGINT END AS low,
CASE o_orderkey % 4 WHEN 0 THEN floor(o_totalprice)::BIGINT + 1000 WHEN 3 THEN 0 ELSE floor(o_totalprice)::BIGINT END AS high FROM orders""")
def q24_parse_amount_text(t: Tables) -> DataFrame:
    n, k = F.floor("o_totalprice"), F.col("o_orderkey") % 4
    money = lambda x: F.concat(F.lit("$"), F.format_number(x, 0))
    text = F.when(k == 0, F.concat(money(n), F.lit(" - "), money(n + 1000))).when(k == 1, F.concat(F.lit(" Over "), money(n))).when(k == 2, money(n)).otherwise("unknown")
    return t.orders.select("o_orderkey", parse_range(text).alias("r")).select("o_orderkey", "r.low", "r.high")


@query(rf"SELECT doc_id, CASE WHEN text IS NULL OR regexp_full_match(text, '({_WS})?') THEN 0 ELSE greatest(1, round_even(length(text) / 4.0, 0)) END::BIGINT AS n FROM documents")
def q25_token_estimate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", token_estimate("text").alias("n"))


@query(rf"""WITH w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_WS}'), lambda x: x <> '') AS ws FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
m AS (SELECT *, length(regexp_replace(text, '[^\x20-\x7e\t\n\r\x0b\x0c]', '', 'g')) / length(text) AS printable, list_sum(list_transform(ws, lambda x: length(x))) / len(ws) AS mean,
list_unique(list_filter(list_transform(ws, lambda x: trim(lower(x), '!"#$%&''()*+,-./:;<=>?@[\]^_`{{|}}~')), lambda x: x IN ('the', 'and', 'of', 'to', 'in', 'a', 'is', 'that', 'for', 'it'))) AS common FROM w)
SELECT doc_id, CASE WHEN len(ws) = 0 THEN 0 ELSE round(round_even(0.4::DOUBLE * printable + 0.3::DOUBLE * (CASE WHEN mean < 2 THEN mean / 2 WHEN mean > 12 THEN greatest(0.3::DOUBLE, 1 - (mean - 12) / 20) ELSE 1 END) + 0.3::DOUBLE * least(1::DOUBLE, common / 3), 4), 3) END::DOUBLE AS confidence FROM m""")
def q26_text_confidence(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.round(text_confidence("text"), 3).alias("confidence"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS us, strftime(o_orderdate, '%Y-%m-%d') AS feed, strftime(o_orderdate, '%Y-%m-%d') AS compact, strftime(o_orderdate, '%Y-%m-%d') AS stamp,
CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'about ' || year(o_orderdate) END AS loose FROM orders""")
def q27_dates(t: Tables) -> DataFrame:
    d, as_ = F.col("o_orderdate"), lambda f: F.date_format("o_orderdate", f)
    return t.orders.select("o_orderkey", iso_from_us(F.concat(F.lit(" "), as_("M/d/yyyy"))).alias("us"), feed_date(as_("M/d/yyyy")).alias("feed"), senate_date(as_("yyyyMMdd")).alias("compact"),
                                                            senate_date(as_("yyyy-MM-dd'T'HH:mm:ss")).alias("stamp"), fara_date(F.when(F.col("o_orderkey") % 2 == 0, as_("M/d/yyyy")).otherwise(F.concat(F.lit("about "), F.year(d)))).alias("loose"))


@query("""WITH w AS (SELECT event_type, greatest(DATE '2024-01-03', max(ts)::DATE - 14) AS first, DATE '2024-02-02' AS last FROM events GROUP BY 1)
SELECT event_type, unnest(range(first::TIMESTAMP, (last + 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM w""")
def q28_reconcile_window(t: Tables) -> DataFrame:
    latest = t.events.groupBy("event_type").agg(F.date_format(F.max("ts"), "yyyyMMdd").alias("latest"))
    return latest.select("event_type", F.explode(reconcile_dates(F.lit("01/03/2024"), "latest", 14, F.to_date(F.lit("2024-02-02")))).alias("day"))


@query("""SELECT l_orderkey, l_linenumber, substr(sha256(l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber || '|' || coalesce(l_returnflag, '')), 1, 16) AS short_key,
sha1(l_orderkey || '|' || coalesce(l_returnflag, '') || '|' || l_partkey) AS match_key FROM lineitem""")
def q29_content_hash_id(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", sha256_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", length=16).alias("short_key"), sha1_key("l_orderkey", "l_returnflag", "l_partkey").alias("match_key"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, '{"k":"' || (CASE WHEN event_type = 'error' THEN '0' ELSE json_extract_string(props, '$.k') END) || '","type":"' || event_type || '"}' AS merged FROM events""")
def q30_json_metadata(t: Tables) -> DataFrame:
    patch = F.when(F.col("event_type") == "error", F.to_json(F.create_map(F.lit("k"), F.lit("0"), F.lit("type"), F.col("event_type")))).otherwise(F.to_json(F.create_map(F.lit("type"), F.col("event_type"))))
    m = merge_json("props", patch)
    return t.events.select("event_id", json_text("props", "k").alias("k"), F.concat(F.lit('{"k":"'), json_text(m, "k"), F.lit('","type":"'), json_text(m, "type"), F.lit('"}')).alias("merged"))




@query("""SELECT p_partkey, ['IBIT', 'COIN', 'BTC', 'ETH', 'XYZ', '-', 'HUT', 'SOL'][p_partkey % 8 + 1] AS symbol, ['crypto_etf', 'crypto_equity', 'direct_crypto', 'direct_crypto', 'unrelated', 'unrelated', 'crypto_equity', 'direct_crypto'][p_partkey % 8 + 1] AS kind,
[0.98, 0.97, 0.99, 0.94, 0, 0, 0.97, 0.94][p_partkey % 8 + 1]::DOUBLE AS confidence FROM part""")
def q31_classify_rules(t: Tables) -> DataFrame:
    pick = lambda *xs: F.element_at(F.array(*(x if not isinstance(x, str) else F.lit(x) for x in xs)), (F.col("p_partkey") % 8 + 1).cast("int"))
    ticker = pick("ibit", "COIN ", "BTC", "", "XYZ", "", "hut", "")
    text = pick("", "shares", "wallet", "Ether  staking", F.col("p_name"), F.concat(F.lit("Marathon "), F.col("p_name")), "", "CRYPTO:SOL")
    return t.part.select("p_partkey", classify(ticker, text).alias("c")).select("p_partkey", F.coalesce("c.symbol", F.lit("-")).alias("symbol"), "c.kind", "c.confidence")


@query(r"""WITH s AS (SELECT s_suppkey, ['Malta', 'malta ', 'Korea', 'Isle' || s_suppkey % 5, 'UK', 'Peru'] AS xs FROM supplier)
SELECT s_suppkey, 'Malta;Korea;Isle' || s_suppkey % 5 || ';UK;Peru' AS countries FROM s""")
def q53_offshore_multivalue(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" Malta;malta |Korea, "), F.lit("Isle"), F.col("s_suppkey") % 5, F.lit("|;UK; Peru, uk"))
    return t.supplier.select("s_suppkey", F.array_join(split_multi(text), ";").alias("countries"))


def _unescaped(x: str) -> str:
    """SQL that resolves the character references that the table has, & last."""
    for name, c in (("&nbsp;", " "), ("&quot;", '"'), ("&copy;", "\u00a9"), ("&middot;", "\u00b7")):
        x = f"replace({x}, '{name}', '{c}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


@query(rf"SELECT page_id, trim(regexp_replace(regexp_replace({_unescaped('html')}, '<[^>]+>', ' ', 'g'), '{_WS}', ' ', 'g')) AS text FROM pages")
def q20_html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", html_to_text("html").alias("text"))


@query("""WITH k AS (SELECT c_custkey, c_custkey::VARCHAR AS n, c_custkey % 3 AS k FROM customer)
SELECT c_custkey, CASE k WHEN 2 THEN 'AC ME' ELSE 'ACME' END AS "Foreign Principal", '01/02/2020' AS "Foreign Principal Registration Date", 'MALTA' AS "Country/Location Represented", n AS "Registration Number", '03/04/2019' AS "Registrant Date", 'SMITH LLC' AS "Registrant Name", '1 Road' AS "Address 1", '' AS "Address 2", 'Kyiv' AS "City", 'DC' AS "State", CASE k WHEN 2 THEN '' ELSE '20001' END AS "Zip" FROM k""")
def q51_fara_repair(t: Tables) -> DataFrame:
    """Rows of all columns, sound or shifted to either side."""
    n, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    sound = ["ACME", "01/02/2020", "MALTA", n, "03/04/2019", "SMITH LLC", "1 Road", "", "Kyiv", "DC", "20001"]
    left = ["ACME,01/02/2020\"", "MALTA", n, "03/04/2019", "SMITH LLC", "1 Road", "", "Kyiv", "DC", "20001", ""]
    right = ["AC", "ME", "01/02/2020", "MALTA", n, "03/04/2019", "SMITH LLC", "1 Road", "", "Kyiv", "DC"]
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return repair_principals(t.customer.select("c_custkey", *(F.when(k == 0, lit(a)).when(k == 1, lit(b)).otherwise(lit(c)).alias(name) for name, a, b, c in zip(PRINCIPAL, sound, left, right))))

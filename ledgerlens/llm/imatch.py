"""Document fingerprints by I-Match.

Of a text's terms only those within a band of inverse document frequency count: common ones say nothing, rare ones
change with every small edit.  The distinct terms left are sorted and hashed, once over the whole lexicon and once
over each of several random subsets of it, so that texts whose terms differ slightly still share a fingerprint.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_BYTES, ids, prepare, slices, stored

MIN_SHARE, MAX_SHARE, SUBSETS, KEEP = 0.001, 0.5, 5, "b"  # a term is in a subset if a hash digit is below KEEP: 11 of 16
FLUSH = 300_000
terms = re.compile(r"\w+").findall
COLUMNS = ["fp_all", *(f"fp_{i}" for i in range(1, SUBSETS + 1))]


def subsets(term: str) -> list[bool]:
    """Of which lexicon subsets the term is."""
    return [hashlib.md5(f"{i}:{term}".encode()).hexdigest()[0] < KEEP for i in range(1, SUBSETS + 1)]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    n = 0

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "df"])
        seen.clear()
        return b
    for b in slices(batches):
        for t in b.column(0).to_pylist():
            n += 1
            if t:
                seen.update(set(terms(t.lower())))
            if len(seen) > FLUSH:
                yield out()
    if n:
        seen[""] = n  # no term is empty: this counts the texts
        yield out()


def lexicon(docs: DataFrame, text: str = "text", low: float = MIN_SHARE, high: float = MAX_SHARE) -> DataFrame:
    """(term, df): terms in at least ``low`` and at most ``high`` of all texts, that is an IDF from -ln high to -ln low.

    As no more than (mean terms a text) / low terms can reach ``low``, its size doesn't grow with the number of texts.
    """
    prepare(docs.sparkSession)
    df = stored(docs.select(F.col(text).alias("text")).mapInArrow(_frequencies, "term string, df long").groupBy("term").agg(F.sum("df").alias("df")))
    n = df.where("term = ''").agg(F.sum("df")).first()[0] or 0
    return df.where((F.col("term") != "") & (F.col("df") >= n * low) & (F.col("df") <= n * high))


def digest(chosen: list[str]) -> str | None:
    return hashlib.md5(" ".join(sorted(chosen)).encode()).hexdigest() if chosen else None


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, term): each text's distinct terms, as they are found everywhere here."""
    for b in slices(batches):
        found = [(i, x) for i, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if t for x in set(terms(t.lower()))]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())], ["row", "term"])


def _print(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within = shared.value
        for b in slices(batches):
            rows = []
            for t in b.column(1).to_pylist():
                held = sorted(within.keys() & set(terms(t.lower()))) if t else []
                rows.append((len(held), digest(held), *(digest([x for x in held if within[x] >> i & 1]) for i in range(SUBSETS))))
            cols = list(zip(*rows)) or [[]] * (SUBSETS + 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], ["doc_id", "n_terms", *COLUMNS])
    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", low: float = MIN_SHARE, high: float = MAX_SHARE, most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_terms, fp_all, fp_1 .. fp_5) for each row.

    Where no term is left (null or empty texts, texts of common or rare words only) a fingerprint is null, and
    nulls are never alike.  Repeated rows count each; rows without an id count but get no fingerprint; other
    columns are never read.  The lexicon goes to the workers if its counted size fits; a band so wide that it
    doesn't is joined with the texts' terms instead.
    """
    words = lexicon(docs, text, low, high)
    n, size = words.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term") + 120), F.lit(0))).first()
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if size <= most_bytes:
        within = {t: sum(x << i for i, x in enumerate(subsets(t))) for t in words.select("term").toArrow()["term"].to_pylist()}
        shared = docs.sparkSession.sparkContext.broadcast(within)
        return d.mapInArrow(_print(shared), "doc_id long, n_terms long, " + ", ".join(f"{c} string" for c in COLUMNS))
    rows = stored(d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    held = rows.mapInArrow(_distinct_terms, "row long, term string").join(words.select("term"), "term", "left_semi")
    pick = [F.lit(True), *(F.substring(F.md5(F.concat(F.lit(f"{i}:"), F.col("term"))), 1, 1) < KEEP for i in range(1, SUBSETS + 1))]
    got = held.groupBy("row").agg(F.count("*").alias("n"), *(F.sort_array(F.collect_list(F.when(p, F.col("term")))).alias(c) for p, c in zip(pick, COLUMNS)))
    return rows.select("row", "doc_id").join(got, "row", "left").select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_terms"), *(F.when(F.size(c) > 0, F.md5(F.concat_ws(" ", c))).alias(c) for c in COLUMNS))


ORACLE = rf"""
WITH t AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'))) AS term FROM documents),
n AS (SELECT count(*) AS n FROM documents),
lexicon AS (SELECT term FROM t, n GROUP BY term, n.n HAVING count(*) >= n.n * {MIN_SHARE} AND count(*) <= n.n * {MAX_SHARE}),
held AS (SELECT doc_id, term FROM t JOIN lexicon USING (term)),
prints AS (SELECT doc_id, count(*) AS n_terms, md5(string_agg(term, ' ' ORDER BY term)) AS fp_all,
{", ".join(f"md5(string_agg(term, ' ' ORDER BY term) FILTER (WHERE substr(md5('{i}:' || term), 1, 1) < '{KEEP}')) AS fp_{i}" for i in range(1, SUBSETS + 1))}
FROM held GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_terms, 0) AS n_terms, {", ".join(COLUMNS)} FROM documents d LEFT JOIN prints USING (doc_id) WHERE d.doc_id IS NOT NULL
"""

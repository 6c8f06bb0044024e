"""Lexical and hybrid retrieval as queries over documents, chunks and vectors."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.collections import cosine
from ..functions.text import _c

STOP = ["a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "will", "with"]
LEXICAL, SEMANTIC = 0.45, 0.55
_SUFFIX = r"(?:ational|ization|fulness|iveness|ingly|edly|ments|ment|ings|ing|ies|ied|ed|es|s|ly)$"


def stem(word: str) -> str:
    """A light English stemmer: one suffix goes if at least three letters stay."""
    m = re.search(_SUFFIX, word)
    return word[: m.start()] if m and m.start() >= 3 else word


def tokens(x: Column | str) -> Column:
    """Lower-case words with their positions kept: stop words become empty, others are stemmed."""
    words = F.regexp_extract_all(F.lower(F.coalesce(_c(x), F.lit(""))), F.lit(r"(?U)(\w+)"), 1)
    stemmed = lambda w: F.when(F.length(F.regexp_replace(w, _SUFFIX, "")) >= 3, F.regexp_replace(w, _SUFFIX, "")).otherwise(w)
    return F.transform(words, lambda w: F.when(w.isin(STOP), "").otherwise(stemmed(w)))


def parse(query: str) -> tuple[list[list[list[str]]], list[list[str]]]:
    """(alternatives, excluded): alternatives of phrases that must all occur; phrases that mustn't.

    Words must all occur, "quoted words" in sequence; ``or`` separates alternatives; a minus excludes.
    """
    groups: list[list[list[str]]] = [[]]
    excluded: list[list[str]] = []
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', query):
        if not minus and word.lower() == "or":
            groups.append([])
            continue
        terms = [stem(w) for w in re.findall(r"\w+", (phrase or word).lower()) if w not in STOP]
        if terms:
            (excluded if minus else groups[-1]).append(terms)
    return [g for g in groups if g], excluded


def _equal_to(word: str):
    return lambda t: t == word  # a second parameter would be the element's position


def _marked(k: int):
    return lambda i: F.struct(i.alias("at"), F.lit(k).alias("of"))


def _followed(other: Column, k: int):
    return lambda at: F.array_contains(other, at + k)


def occurrences(toks: Column, phrase: list[str]) -> Column:
    """Positions at which the phrase begins."""
    same = F.transform(toks, lambda t: t == phrase[0])
    for k, word in enumerate(phrase[1:], 1):
        rest = F.slice(toks, F.lit(k + 1), F.greatest(F.size(toks), F.lit(0)))
        same = F.zip_with(same, F.transform(rest, _equal_to(word)), lambda x, y: F.coalesce(x & y, F.lit(False)))
    return F.filter(F.transform(same, lambda x, i: F.when(x, i)), lambda i: i.isNotNull())


def cover_density(positions: list[Column]) -> Column:
    """Sum over minimal covers of 1 / (1 + words between): short stretches that hold every phrase count most."""
    if len(positions) == 1:
        return F.size(positions[0]).cast("double")
    marks = F.array_sort(F.concat(*(F.transform(p, _marked(k)) for k, p in enumerate(positions))))
    n, none = len(positions), F.lit(-1)
    start = F.struct(F.array_repeat(none, n).alias("last"), F.lit(-1).alias("from"), F.lit(0.0).alias("sum"))

    def step(s: Column, m: Column) -> Column:
        last = F.transform(s["last"], lambda v, i: F.when(i == m["of"], m["at"]).otherwise(v))
        low = F.array_min(last)
        add = (low >= 0) & (low > s["from"])
        return F.struct(last.alias("last"), F.when(add, low).otherwise(s["from"]).alias("from"),
                        (s["sum"] + F.when(add, 1.0 / (1.0 + F.greatest(m["at"] - low - (n - 1), F.lit(0)))).otherwise(0.0)).alias("sum"))
    return F.aggregate(marks, start, step, lambda s: s["sum"])


def ranked(df: DataFrame, query: str, text: str) -> DataFrame:
    """``df`` with _r: null where the text doesn't match the query, else the sum of its alternatives' cover densities.

    Tokens and positions are made once a row: a generator stands between, which no rule of the optimizer copies.
    """
    groups, excluded = parse(query)
    if not groups:
        return df.withColumn("_r", F.lit(None).cast("double"))
    phrases = [p for g in groups for p in g] + excluded
    df = df.select("*", F.explode(F.array(tokens(text))).alias("_toks"))
    df = df.select("*", F.explode(F.array(F.struct(*(occurrences(F.col("_toks"), p).alias(f"p{i}") for i, p in enumerate(phrases))))).alias("_at")).drop("_toks")
    score, any_, i = F.lit(0.0), F.lit(False), 0
    for g in groups:
        found, i = [F.col("_at")[f"p{k}"] for k in range(i, i + len(g))], i + len(g)
        ok = F.lit(True)
        for f in found:
            ok &= F.size(f) > 0
        any_ |= ok
        score = score + F.when(ok, cover_density(found)).otherwise(0.0)
    for k in range(len(excluded)):
        any_ &= F.size(F.col("_at")[f"p{i + k}"]) == 0
    return df.select("*", F.explode(F.array(F.when(any_, score))).alias("_r")).drop("_at")


def scoped(df: DataFrame, **scope) -> DataFrame:
    """Filters for those of the scopes that are set: equality, or membership where the column is an array."""
    for c, v in scope.items():
        if v is not None:
            df = df.where(F.array_contains(c, v) if df.schema[c].dataType.typeName() == "array" else F.col(c) == v)
    return df


def lexical(chunks: DataFrame, query: str, limit: int, key: str = "chunk_id", text: str = "content", doc_rank: Column | None = None, **scope) -> DataFrame:
    """(key, lexical_score, semantic_score, combined_score): the best matches, ties by key."""
    scored = ranked(scoped(chunks, **scope), query, text)
    both = F.coalesce("_r", F.lit(0.0)) + (F.coalesce(doc_rank, F.lit(0.0)) if doc_rank is not None else F.lit(0.0))
    hit = F.col("_r").isNotNull() | (doc_rank.isNotNull() if doc_rank is not None else F.lit(False))
    out = scored.where(hit).select(key, both.alias("lexical_score"), F.lit(0.0).alias("semantic_score"), both.alias("combined_score"))
    return out.orderBy(F.desc("combined_score"), key).limit(max(1, limit))


def hybrid(chunks: DataFrame, query: str, vector: list[float] | None, limit: int, key: str = "chunk_id", text: str = "content", embedding: str = "embedding", nulls_first: bool = False, **scope) -> DataFrame:
    """Lexical and cosine scores combined; what has neither a hit nor a vector isn't a candidate.

    ``nulls_first`` ranks hits without a vector first, as a descending sort of nulls does elsewhere; else a missing
    vector counts as a cosine of 0.  Scores are rounded to six digits so that ties don't hang on summation order.
    """
    if not vector:
        return lexical(chunks, query, limit, key, text, **scope)
    q = F.array(*(F.lit(float(x)) for x in vector))
    lex = F.coalesce("_r", F.lit(0.0))
    cand = ranked(scoped(chunks, **scope), query, text).select(key, lex.alias("lexical_score"), F.round(cosine(F.col(embedding), q), 6).alias("_s")).where((F.col("lexical_score") > 0) | F.col("_s").isNotNull())
    s = F.col("_s") if nulls_first else F.coalesce("_s", F.lit(0.0))
    cand = cand.withColumn("combined_score", F.round(LEXICAL * F.col("lexical_score") + SEMANTIC * s, 6))
    top = cand.orderBy(F.desc_nulls_first("combined_score"), key).limit(max(1, limit))
    return top.select(key, "lexical_score", F.coalesce("_s", F.lit(0.0)).alias("semantic_score"), F.coalesce("combined_score", F.lit(0.0)).alias("combined_score"))


def inverted(texts: DataFrame, key: str = "chunk_id", text: str = "content") -> DataFrame:
    """(term, key, positions): where each stemmed term stands in each text, in order; stop words aren't listed.

    Written once, partitioned or bucketed by term, it answers queries without a look at the texts.
    """
    each = texts.select(key, F.posexplode(tokens(text)).alias("_at", "term")).where("term <> ''")
    return each.groupBy("term", key).agg(F.array_sort(F.collect_list("_at")).alias("positions"))


def indexed(postings: DataFrame, query: str, limit: int | None = None, key: str = "chunk_id") -> DataFrame:
    """(key, lexical_score): what ``lexical`` finds, out of an inverted table, of which only the query's terms are read."""
    groups, excluded = parse(query)
    terms = sorted({w for g in [*groups, excluded] for p in g for w in p})
    if not groups:
        return postings.select(key, F.lit(0.0).alias("lexical_score")).where("false")
    none = F.array().cast("array<int>")
    held = postings.where(F.col("term").isin(terms)).groupBy(key).agg(*(F.coalesce(F.first(F.when(F.col("term") == w, F.col("positions")), ignorenulls=True), none).alias(f"t{i}") for i, w in enumerate(terms)))

    def begins(phrase: list[str]) -> Column:
        first, *rest = (F.col(f"t{terms.index(w)}") for w in phrase)
        for k, other in enumerate(rest, 1):
            first = F.filter(first, _followed(other, k))
        return first
    phrases = [p for g in groups for p in g] + excluded
    held = held.select(key, *(begins(p).alias(f"p{i}") for i, p in enumerate(phrases)))
    score, hit, i = F.lit(0.0), F.lit(False), 0
    for g in groups:
        found, i = [F.col(f"p{k}") for k in range(i, i + len(g))], i + len(g)
        ok = F.lit(True)
        for f in found:
            ok &= F.size(f) > 0
        hit |= ok
        score = score + F.when(ok, cover_density(found)).otherwise(0.0)
    for k in range(len(excluded)):
        hit &= F.size(f"p{i + k}") == 0
    out = held.where(hit).select(key, score.alias("lexical_score"))
    return out.orderBy(F.desc("lexical_score"), key).limit(max(1, limit)) if limit is not None else out


def with_documents(chunk_scores: DataFrame, document_scores: DataFrame, chunks: DataFrame, limit: int, key: str = "chunk_id", parent: str = "document_id") -> DataFrame:
    """(key, lexical_score): a chunk's own score and its document's, summed; a hit of either is enough."""
    own, whole = chunk_scores.select(key, F.col("lexical_score").alias("_own")), document_scores.select(parent, F.col("lexical_score").alias("_doc"))
    both = chunks.select(key, parent).join(own, key, "left").join(whole, parent, "left").where("_own is not null or _doc is not null")
    return both.select(key, (F.coalesce("_own", F.lit(0.0)) + F.coalesce("_doc", F.lit(0.0))).alias("lexical_score")).orderBy(F.desc("lexical_score"), key).limit(max(1, limit))

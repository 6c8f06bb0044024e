"""Company to award recipient: conservative scores on names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, company_tokens, normalize_name, strip_corporate
from .relational import pick_per_key

LEAST = 55


def token_score(query: Column, other: Column) -> Column:
    """Of two token arrays: 85 all (of two or more), 75 or 65 by the share of two or more, 55 the only one, else 0."""
    hits = F.size(F.filter(query, lambda t: F.array_contains(other, t)))
    n, share = F.size(query), hits / F.size(query)
    return (F.when((n >= 2) & (hits == n), 85).when((hits >= 2) & (share >= 0.8), 75).when((hits >= 2) & (share >= 0.6), 65)
            .when((hits == 1) & (n == 1), 55).otherwise(0))


def score(query: Column | str, recipient: Column | str) -> Column:
    """100 equal without legal forms, 95 equal, else by tokens; 0 if either is blank."""
    q, r = _c(query), _c(recipient)
    nq, nr = normalize_name(q), normalize_name(r)
    sq, sr = (normalize_name(F.coalesce(strip_corporate(x), x)) for x in (q, r))
    tq, tr = company_tokens(q), company_tokens(r)
    return (F.when((nq == "") | (nr == ""), 0).when((sq != "") & (sq == sr), 100).when(nq == nr, 95)
            .when((F.size(tq) == 0) | (F.size(tr) == 0), 0).otherwise(token_score(tq, tr)))


def profile_score(query: Column | str, names: Column) -> Column:
    """The best score over a recipient's own, parent and alternate names; 0 without any."""
    return F.coalesce(F.array_max(F.transform(F.array_compact(names), lambda n: score(query, n))), F.lit(0))


def select_matches(candidates: DataFrame, query: str, name: str, key: str, amount: str, recipient: str, limit: int = 3, least: int = LEAST) -> DataFrame:
    """The ``limit`` best recipients of each key by score, amount and name; each recipient once."""
    scored = candidates.withColumn("score", score(query, name)).where(F.col("score") >= least)
    order = (F.desc("score"), F.desc(F.coalesce(amount, F.lit(0.0))), F.asc(name))
    return pick_per_key(pick_per_key(scored, [key, recipient], *order), [key], *order, n=max(1, limit))


def candidates(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs of names that share a telling word or are equal without legal forms; all others score 0."""
    keys = lambda x: F.explode(F.array_distinct(F.concat(company_tokens(x), F.array(F.concat(F.lit("="), normalize_name(F.coalesce(strip_corporate(x), F.col(x))))))))
    return left.select(a, keys(a).alias("_w")).join(right.select(b, keys(b).alias("_w")), "_w").select(a, b).distinct()

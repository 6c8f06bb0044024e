"""Names to registry members, set at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _keys_of, normalize_name


def with_keys(df: DataFrame, name: str, state: Column, first: str | None = None, last: str | None = None) -> DataFrame:
    """``df`` with _norm and _keys, its lookup keys.

    Names are normalised once a row: a generator stands between, which no rule of the optimizer copies.
    """
    tail = normalize_name(last) if last else F.lit("")
    other = F.when(tail == "", "").otherwise(F.trim(F.concat_ws(" ", normalize_name(first), tail))) if first else tail
    df = df.select("*", state.alias("_state"), F.explode(F.array(F.struct(normalize_name(name).alias("n"), other.alias("o")))).alias("_nm"))
    keys = F.concat(_keys_of(F.col("_nm.n"), F.col("_state")), _keys_of(F.col("_nm.o"), F.col("_state"))) if last else _keys_of(F.col("_nm.n"), F.col("_state"))
    return df.select("*", F.col("_nm.n").alias("_norm"), F.array_distinct(F.array_compact(keys)).alias("_keys")).drop("_nm")


def known(members: DataFrame) -> DataFrame:
    """(_lo, _hi, _norm, _state, _keys): each name in a state once, with the smallest and largest member that bears it."""
    by = members.groupBy(F.coalesce("name", F.lit("")).alias("_name"), F.upper(F.trim(F.coalesce("state", F.lit("")))).alias("_st")).agg(F.min("id").alias("_lo"), F.max("id").alias("_hi"))
    return with_keys(by, "_name", F.col("_st")).drop("_name", "_st")


def key_index(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The smallest and largest member that each lookup key, and each key within a state, leads to.

    All that a unique pick needs, so that a key of many members costs one row.  ``names`` are as ``known`` gives them.
    """
    inside = names.select("_lo", "_hi", "_state", F.explode("_keys").alias("key")).groupBy("key", "_state").agg(F.min("_lo").alias("_lo_in"), F.max("_hi").alias("_hi_in"))
    return inside.groupBy("key").agg(F.min("_lo_in").alias("_lo"), F.max("_hi_in").alias("_hi")), inside


def unique_pick(state: Column) -> Column:
    """The id of the only candidate in the state, or if none is in it the only one at all; null if it isn't unique."""
    inside = (state != "") & F.col("_lo_in").isNotNull()
    return F.when(inside, F.when(F.col("_lo_in") == F.col("_hi_in"), F.col("_lo_in"))).otherwise(F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")))


def _shapes(norm: str, beginnings: str, whole: str) -> Column:
    """A name's beginnings, itself, and itself without spaces, marked by what they are to meet."""
    starts = F.transform(F.sequence(F.lit(1), F.length(norm)), lambda n: F.concat(F.lit(beginnings), F.substring(F.col(norm), F.lit(1), n)))
    return F.concat(starts, F.array(F.concat(F.lit(whole), F.col(norm)), F.concat(F.lit("run:"), F.replace(F.col(norm), F.lit(" "), F.lit("")))))


def _shape_index(names: DataFrame) -> DataFrame:
    """(_shape, _st, _lo, _hi): the smallest and largest member that a shape leads to, in a state and (*) anywhere."""
    rows = names.where("_norm <> ''").select("_lo", "_hi", F.explode(F.array_distinct(F.array(F.lit("*"), F.when(F.col("_state") == "", "*").otherwise(F.col("_state"))))).alias("_st"), "_norm")
    return rows.select("_lo", "_hi", "_st", F.explode(_shapes("_norm", "is:", "of:")).alias("_shape")).groupBy("_shape", "_st").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))


def resolve(rows: DataFrame, members: DataFrame, row_id: str = "row_id", name: str = "name", state: str | None = "state", first: str | None = None, last: str | None = None, bioguide: str | None = None) -> DataFrame:
    """(row_id, member_id, matched_key, matched_kind) for every row; nulls where nothing matches.

    With a bioguide id that lookup alone decides, even if it finds nothing.  Otherwise the first key, in order of
    how telling it is, with a unique candidate wins; then, within the state, names of which one begins the other.
    All joins are by key: for what is left unresolved, names meet by their beginnings.  What several rows ask alike is
    resolved once.  The planner sizes exploded keys by the tables they come from and would broadcast any number of
    them, so joins merge.
    """
    clean = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))) if c else F.lit("")
    bio, named = clean(bioguide), {"_name": name, "_first": first, "_last": last}
    asks = {"_bio": bio} | {k: F.when(bio == "", F.coalesce(F.col(c), F.lit(""))).otherwise("") for k, c in named.items() if c} | {"_st": F.when(bio == "", clean(state)).otherwise("")}
    asks = {k: v for k, v in asks.items() if (k != "_bio" or bioguide) and (k != "_st" or state)}
    base = rows.select(row_id, *(v.alias(k) for k, v in asks.items()))
    asked = base.select(*asks).distinct()
    texts = asked.where("_bio = ''") if bioguide else asked
    names = known(members)
    every, inside = key_index(names)
    keyed = with_keys(texts, "_name", F.col("_st") if state else F.lit(""), "_first" if first else None, "_last" if last else None)
    tried = keyed.select(*asks, "_norm", "_state", F.posexplode_outer("_keys").alias("_pos", "key")).join(every.hint("merge"), "key", "left").join(inside.hint("merge"), ["key", "_state"], "left")
    member = unique_pick(F.col("_state"))
    tried = tried.groupBy(*asks, "_norm", "_state").agg(F.min(F.when(member.isNotNull(), F.struct("_pos", member.alias("member_id"), F.col("key").alias("matched_key")))).alias("_m"))
    answer = lambda df, member_id, key, kind: df.select(*asks, F.col(member_id).alias("member_id"), key.alias("matched_key"), F.lit(kind).alias("matched_kind"))
    found = answer(tried.where("_m is not null"), "_m.member_id", F.col("_m.matched_key"), "key")
    rest = tried.where("_m is null").where("_norm <> ''").select(*asks, "_norm", "_state")
    st = F.when(F.col("_state") == "", "*").otherwise(F.col("_state")).alias("_st")
    shapes = rest.select("_norm", "_state").distinct().select("_norm", "_state", st, F.explode(_shapes("_norm", "of:", "is:")).alias("_shape"))
    fuzzy = shapes.join(_shape_index(names).hint("merge"), ["_shape", "_st"]).groupBy("_norm", "_state").agg(F.min("_lo").alias("_one"), F.max("_hi").alias("_last_one")).where("_one = _last_one")
    found = found.unionByName(answer(rest.join(fuzzy.hint("merge"), ["_norm", "_state"]), "_one", F.lit(None).cast("string"), "prefix"))
    if bioguide:
        own = members.groupBy(F.upper(F.trim("bioguide_id")).alias("_b")).agg(F.max("id").alias("_id")).where("_b <> ''")
        found = found.unionByName(answer(asked.join(own.hint("merge"), F.col("_bio") == F.col("_b")), "_id", F.col("_b"), "bioguide"))
    return base.join(found.hint("merge"), [*asks], "left").select(row_id, "member_id", "matched_key", "matched_kind")

"""String expressions: clean-up, name normalisation, lookup keys, company names.  All stay in the JVM but one."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# letters whose canonical decomposition is a base letter and marks, over the Latin blocks
_ACCENTED = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.decomposition(c) and not unicodedata.decomposition(c).startswith("<")]
_PLAIN = ["".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn") for c in _ACCENTED]
_PAIRS = [(a, p) for a, p in zip(_ACCENTED, _PLAIN) if len(p) == 1]
TITLES = ["hon", "representative", "rep", "senator", "sen"]
SUFFIXES = ["jr", "sr", "ii", "iii", "iv"]
CORPORATE = "co company corp corporation group holding holdings inc incorporated limited llc lp ltd plc".split()
GENERIC = "and the holdings holding group technologies technology systems system".split()


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.transform(F.array(x), f)[0]


def strip_ws(x: Column | str) -> Column:
    """Trim white space of any kind, as Unicode has it, at both ends."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def squeeze(x: Column | str) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_c(x), r"(?U)[^\S ]\s*| \s+", " "))  # single spaces stay as they are


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(strip_ws(_c(x)), F.lit(""))


def first_filled(*xs: Column | str) -> Column:
    """The first value that isn't blank, trimmed."""
    return F.coalesce(*(blank_to_null(x) for x in xs))


def strip_accents(x: Column | str) -> Column:
    """Latin letters without their diacritics, and no combining marks."""
    return F.regexp_replace(F.translate(_c(x), "".join(a for a, _ in _PAIRS), "".join(p for _, p in _PAIRS)), r"\p{Mn}+", "")


@F.arrow_udf(StringType())
def strip_accents_any(x: pa.Array) -> pa.Array:
    """The same for any script, by canonical decomposition."""
    return pa.array([None if v is None else "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn") for v in x.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def unescape(x: pa.Array) -> pa.Array:
    """Character references of HTML resolved."""
    return pa.array([None if v is None else html.unescape(v) for v in x.to_pylist()], pa.string())


def html_to_text(x: Column | str, entities: bool = True) -> Column:
    """Tags become spaces, character references their characters, white space one space."""
    x = F.regexp_replace(_c(x), r"\x{00a0}|&nbsp;", " ")
    return squeeze(F.regexp_replace(unescape(x) if entities else x, "<[^>]+>", " "))


def normalize_name(x: Column | str, accents=strip_accents) -> Column:
    """A person's name for lookup: no accents, title, generation or punctuation; lower case, single spaces."""
    x = strip_ws(accents(F.coalesce(_c(x), F.lit(""))))
    x = F.regexp_replace(x, rf"(?i)^(?:{'|'.join(TITLES)})(?:\. | )", "")
    words = F.split(F.regexp_replace(x, r"[.,'-]", " "), r"(?U)\s+")
    words = F.filter(words, lambda w: ~F.lower(w).isin(SUFFIXES))
    words = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}]", "")))
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


def _keys_of(name: Column, state: Column) -> Column:
    return bound(F.struct(name.alias("n"), state.alias("s")), lambda v: bound(F.split(v["n"], " "), lambda p: _keys(v["n"], p, v["s"])))


def _keys(name: Column, parts: Column, state: Column) -> Column:
    last, ends = F.element_at(parts, -1), F.concat_ws(" ", F.element_at(parts, 1), F.element_at(parts, -1))
    with_state = lambda x: F.when(state != "", F.concat(x, F.lit("|"), state))
    more = F.when(F.size(parts) >= 2, F.array(ends, with_state(ends), last, with_state(last))).otherwise(F.array().cast("array<string>"))
    return F.when(name != "", F.concat(F.array(name, with_state(name)), more)).otherwise(F.array().cast("array<string>"))


def lookup_keys(name: Column | str, first: Column | str | None = None, last: Column | str | None = None, state: Column | str | None = None) -> Column:
    """Keys a name can be found by, the most telling first: whole, first and last, last; each also with the state."""
    st = F.upper(strip_ws(F.coalesce(_c(state), F.lit("")))) if state is not None else F.lit("")
    keys = _keys_of(normalize_name(name), st)
    if last is not None:
        named = F.struct((normalize_name(first) if first is not None else F.lit("")).alias("f"), normalize_name(last).alias("l"))
        other = bound(named, lambda v: F.when(v["l"] == "", "").when(v["f"] != "", F.concat_ws(" ", v["f"], v["l"])).otherwise(v["l"]))
        keys = F.concat(keys, _keys_of(normalize_name(other), st))
    return F.array_distinct(F.array_compact(keys))


def distinct_ignoring_case(xs: Column) -> Column:
    """The first of entries that are equal in lower case, in order."""
    seen = F.aggregate(xs, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))
    return F.coalesce(seen, F.array().cast("array<string>"))


def split_multi(x: Column | str) -> Column:
    """Entries of a list in one text: separated by ; or |, and by commas within entries of over 3 characters."""
    trimmed = F.transform(F.split(F.replace(F.coalesce(_c(x), F.lit("")), F.lit("|"), F.lit(";")), ";"), strip_ws)

    def parts(item: Column) -> Column:
        subs = F.filter(F.transform(F.split(item, ","), strip_ws), lambda s: s != "")
        return F.when(item.contains(",") & (F.length(item) > 3) & (F.size(subs) > 1), subs).otherwise(F.array(item))
    return distinct_ignoring_case(F.flatten(F.transform(F.filter(trimmed, lambda t: t != ""), parts)))


def strip_corporate(x: Column | str) -> Column:
    """A company's name without its legal form; null if nothing is left."""
    x = F.regexp_replace(strip_ws(_c(x)), rf"(?i)\b(?:{'|'.join(CORPORATE)})\b\.?", " ")
    return F.nullif(F.regexp_replace(squeeze(x), r"^[ ,.-]+|[ ,.-]+$", ""), F.lit(""))


def company_tokens(x: Column | str) -> Column:
    """The telling words of a company's name."""
    base = F.coalesce(strip_corporate(x), strip_ws(_c(x)), F.lit(""))
    return F.filter(F.split(normalize_name(base), " "), lambda w: (F.length(w) > 1) & ~w.isin(GENERIC))


def alias_key(x: Column | str) -> Column:
    base = F.coalesce(strip_corporate(x), blank_to_null(x))
    return F.nullif(F.upper(squeeze(F.regexp_replace(normalize_name(base), "[^a-z0-9]+", " "))), F.lit(""))


def name_variants(x: Column | str) -> Column:
    """Spellings to search a company by: & as AND or space, and without full stops or commas."""
    x = _c(x)
    tries = F.array(x, *(F.when(x.contains(a), F.replace(x, F.lit(a), F.lit(b))) for a, b in (("&", "AND"), ("&", " "), (".", " "), (",", " "))))
    clean = F.transform(F.array_compact(tries), lambda v: F.regexp_replace(squeeze(v), r"^[ ,.-]+|[ ,.-]+$", ""))
    return distinct_ignoring_case(F.filter(clean, lambda v: v != ""))


_SECURITY = r"(?i)\b(?:common stock|common|ordinary shares|(?:class|series) [a-z0-9-]+)\b.*$"
_BRACKETS = r"\s*\((?:[A-Z.]{1,10}|CRYPTO:[A-Z]+)\)\s*$"


def _without_security(x: Column) -> Column:
    """A label up to the kind of security, without the ticker or exchange that ends it in brackets."""
    x = F.regexp_replace(F.regexp_replace(x, _SECURITY, ""), "^[ -]+|[ -]+$", "")
    return strip_ws(F.regexp_replace(x, _BRACKETS, ""))


def company_query(x: Column | str, ticker: Column | str | None = None) -> Column:
    """What to search a company by, from a noisy asset label; null if nothing is left.

    An amount before and account names in front of the company go, as do the ticker or exchange in brackets, the kind
    of security, and what a table's columns put before the name; of several lines the last telling one counts.
    """
    raw = blank_to_null(x)
    sign = F.upper(_c(ticker)) if ticker is not None else F.lit(None).cast("string")
    t = strip_ws(F.regexp_replace(F.regexp_replace(unescape(raw), r"[\r\n\t]+", " "), r"\x{00a0}", " "))
    t = strip_ws(F.regexp_replace(t, r"^\$[-.,\d\s]+\s", ""))
    t = strip_ws(F.element_at(F.split(t, ">"), -1))
    t = F.when(t.rlike(r"(?i)\b(?:ira|401\(k\)|retirement|account|brokerage|trust)\b") & t.contains(") "), strip_ws(F.element_at(F.split(t, r"\) "), -1))).otherwise(t)
    named = F.concat(F.lit(r"(?i)(?<=\S)\s+\((?:\Q"), sign, F.lit(r"\E|OTC|AMEX|NYSE|NASDAQ)\)\s*$"))
    t = F.when(F.coalesce(sign, F.lit("")) != "", F.regexp_replace(t, named, F.lit(""))).otherwise(t)
    t = F.coalesce(F.element_at(F.filter(F.transform(F.split(t, r"\s{2,}"), strip_ws), lambda v: v != ""), -1), t)

    def line(v: Column) -> Column:
        own = F.concat(F.lit("("), F.coalesce(F.nullif(sign, F.lit("")), F.lit("\n")), F.lit(")"))
        return _without_security(F.when(F.upper(v).contains(own), F.regexp_replace(v, r"\([^(]*$", "")).otherwise(v))
    lines = F.filter(F.transform(F.split(raw, r"[\r\n]+"), lambda v: strip_ws(F.regexp_replace(v, r"\t+", " "))), lambda v: F.length(v) > 2)
    told = F.filter(F.transform(lines, line), lambda v: (v != "") & ~F.lower(v).startswith("direction.") & ~F.lower(v).contains("portfolio rebalance"))
    t = F.when(raw.rlike(r"[\r\n]"), F.coalesce(F.element_at(told, -1), t)).otherwise(t)
    return F.nullif(F.regexp_replace(squeeze(_without_security(t)), r"^[ ,.-]+|[ ,.-]+$", ""), F.lit(""))


#: Names that large companies win contracts under: ticker, key of the name, names.
ALIASES = [("AVGO", "BROADCOM", "AVAGO TECHNOLOGIES;CA, INC.;VMWARE"), ("CVS", "CVS HEALTH", "CVS PHARMACY;CAREMARK;MINUTECLINIC;CORAM"), ("JNJ", "JOHNSON JOHNSON", "JANSSEN;ETHICON;DEPUY"), ("JPM", "JPMORGAN CHASE", "JPMORGAN CHASE BANK;J. P. MORGAN;JPMORGAN"),
           ("MRK", "MERCK", "MERCK SHARP;MERCK SHARP & DOHME;MSD"), ("ORCL", "ORACLE", "ORACLE AMERICA;ORACLE USA;ORACLE CORPORATION"), ("T", "AT T", "AT&T;AT&T CORP;AT&T SERVICES"), ("UNH", "UNITEDHEALTH", "OPTUM;UNITED HEALTHCARE;OPTUMSERVE;LEWIN GROUP"), ("VZ", "VERIZON", "VERIZON BUSINESS;CELLCO PARTNERSHIP;VERIZON WIRELESS")]


def company_queries(name: Column | str, asset: Column | str | None = None, ticker: Column | str | None = None) -> Column:
    """All that a company is searched by, in order: spellings of its cleaned labels, of these without legal forms, and known other names."""
    none = F.array().cast("array<string>")
    parts = []
    for x in (asset, name):
        if x is not None:
            q = company_query(x, ticker)
            bare = strip_corporate(q)
            parts += [F.when(q.isNotNull(), name_variants(q)), F.when(F.lower(bare) != F.lower(q), name_variants(bare))]
    known = lambda at, key: F.create_map(*(v for a in ALIASES for v in (F.lit(a[at]), F.array(*map(F.lit, a[2].split(";"))))))[key]
    if ticker is not None:
        parts.append(known(0, F.upper(_c(ticker))))
    parts.append(known(1, alias_key(name)))
    return distinct_ignoring_case(F.flatten(F.array(*(F.coalesce(p, none) for p in parts))))


def text_confidence(x: Column | str) -> Column:
    """How much a text looks like real prose, 0 to 1: printable characters, length of words, common English words."""
    x = F.coalesce(_c(x), F.lit(""))
    printable = F.length(F.regexp_replace(x, r"[^\x20-\x7e\t\n\r\x0b\x0c]", "")) / F.length(x)
    words = F.filter(F.split(strip_ws(x), r"(?U)\s+"), lambda w: w != "")
    mean = F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)) / F.size(words)
    shape = F.when(mean < 2, mean / 2).when(mean > 12, F.greatest(F.lit(0.3), 1 - (mean - 12) / 20)).otherwise(1.0)
    bare = F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", ""))
    common = F.size(F.array_intersect(bare, F.array(*map(F.lit, ("the", "and", "of", "to", "in", "a", "is", "that", "for", "it")))))
    score = 0.4 * printable + 0.3 * shape + 0.3 * F.least(F.lit(1.0), common / 3)
    return F.when(F.size(words) == 0, 0.0).otherwise(F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4))


def token_estimate(x: Column | str) -> Column:
    """A quarter of the characters, rounded half to even, at least 1; 0 for null and blank texts."""
    x = F.coalesce(_c(x), F.lit(""))
    return F.when(strip_ws(x) == "", 0).otherwise(F.greatest(F.lit(1), F.bround(F.length(x) / 4.0, 0).cast("int"))).cast("long")

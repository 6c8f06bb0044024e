"""Foreign-agent registration rows: shifted columns, split names, broken text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fara_date
from ..functions.text import blank_to_null, strip_ws

_DATE = r"^\s*\d{1,2}/\d{1,2}/\d{4}\s*$"


def is_date(x: Column) -> Column:
    return F.coalesce(x.rlike(_DATE), F.lit(False))


def is_number(x: Column) -> Column:
    return F.coalesce(strip_ws(x).rlike(r"^\d+$"), F.lit(False))


def merge_broken(a: Column, b: Column) -> Column:
    """Two halves of a text that a delimiter within it tore apart."""
    return blank_to_null(F.concat_ws(" ", blank_to_null(a), blank_to_null(b)))


def split_trailing_date(x: Column) -> Column:
    """(text, day) of a text that ends with a date; day is null otherwise."""
    pattern = r"(?s)^(.*?)\s*(\d{1,2}/\d{1,2}/\d{4})\s*$"
    return F.struct(F.when(x.rlike(pattern), blank_to_null(F.regexp_extract(x, pattern, 1))).otherwise(blank_to_null(x)).alias("text"), F.when(x.rlike(pattern), fara_date(F.regexp_extract(x, pattern, 2))).alias("day"))


def address(*parts: Column | str) -> Column:
    """Parts that aren't blank, joined by commas; null if there are none."""
    return F.nullif(F.concat_ws(", ", *(blank_to_null(p) for p in parts)), F.lit(""))


PRINCIPAL = ["Foreign Principal", "Foreign Principal Registration Date", "Country/Location Represented", "Registration Number", "Registrant Date", "Registrant Name", "Address 1", "Address 2", "City", "State", "Zip"]


def repair_principals(rows: DataFrame) -> DataFrame:
    """Bulk rows of foreign principals with shifted columns put right; rows with a registration number stay as they are.

    A date within the principal's name has moved what follows to the left by one; a name torn in two has moved it to
    the right by one.  Which it is shows where a number stands before a date.  Columns beyond PRINCIPAL stay.
    """
    q = {c: F.col(f"`{c}`") for c in PRINCIPAL}
    v = {c: blank_to_null(x) for c, x in q.items()}
    name, day, country, number, since, registrant, *place = (v[c] for c in PRINCIPAL)
    dated = lambda x: F.coalesce(x.rlike(r"^(?:\d{2}/\d{2}/\d{4}|\d{4}-\d{2}-\d{2})$"), F.lit(False))
    bare = lambda x: F.regexp_replace(x, r'^[ "]+|[ "]+$', "")
    tail = r'^(.*?)[,\s]+(\d{2}/\d{2}/\d{4})"?$'
    inside = F.coalesce(name.rlike(tail), F.lit(False))
    left = is_number(country) & dated(number)
    right = ~left & is_number(since) & dated(registrant)
    whole = F.nullif(strip_ws(F.replace(F.concat_ws(" ", bare(name), bare(day)), F.lit(' ,"'), F.lit(","))), F.lit(""))
    own = F.when(inside, F.coalesce(F.nullif(bare(F.regexp_extract(name, tail, 1)), F.lit("")), q[PRINCIPAL[0]])).otherwise(q[PRINCIPAL[0]])
    own_day = F.when(inside, F.regexp_extract(name, tail, 2)).otherwise(q[PRINCIPAL[1]])
    to_left = [own, own_day, day, country, number, since, registrant, *place[:-1]]
    to_right = [F.coalesce(whole, own), country, number, since, registrant, *place, F.lit("")]
    kept = [own, own_day, *(q[c] for c in PRINCIPAL[2:])]
    blank = lambda x: F.coalesce(x, F.lit(""))
    fix = {c: F.when(is_number(number), q[c]).when(left, l if i < 2 else blank(l)).when(right, r if i < 1 else blank(r)).otherwise(s) for i, (c, l, r, s) in enumerate(zip(PRINCIPAL, to_left, to_right, kept))}
    return rows.select(*(fix[c].alias(c) if c in fix else F.col(f"`{c}`") for c in rows.columns))

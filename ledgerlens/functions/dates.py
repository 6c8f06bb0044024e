"""Date expressions; what is "today" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, blank_to_null, bound, strip_ws


def iso_from_us(x: Column | str) -> Column:
    """m/d/yyyy or ISO text as ISO text, digits only: whether the day exists isn't asked."""
    us = lambda p: F.concat(p[2], F.lit("-"), F.lpad(p[0], 2, "0"), F.lit("-"), F.lpad(p[1], 2, "0"))
    return bound(strip_ws(_c(x)), lambda v: F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}$"), v).when(v.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), bound(F.split(v, "/"), us)))


def feed_date(x: Column | str) -> Column:
    """The same, but text of another form is kept as it is."""
    return F.coalesce(iso_from_us(x), blank_to_null(x))


def senate_date(x: Column | str) -> Column:
    """ISO text with anything after it, yyyymmdd, or m/d/y; null otherwise."""
    x = strip_ws(_c(x))
    p = F.transform(F.split(x, "/"), strip_ws)
    us = F.concat(F.lpad(p[2], 4, "0"), F.lit("-"), F.lpad(p[0], 2, "0"), F.lit("-"), F.lpad(p[1], 2, "0"))
    return (F.when(x.isin("", "--", "N/A"), None).when(x.rlike(r"^.{4}-.{2}-.{2}"), F.substring(x, 1, 10))
            .when(x.rlike(r"^\d{8}$"), F.concat(F.substring(x, 1, 4), F.lit("-"), F.substring(x, 5, 2), F.lit("-"), F.substring(x, 7, 2)))
            .when((F.size(p) == 3) & F.forall(p, lambda v: v.rlike(r"^\d+$")), us))


def fara_date(x: Column | str) -> Column:
    """Three formats as ISO text; other text is kept as it is."""
    x = blank_to_null(x)
    return F.coalesce(*(F.date_format(F.try_to_timestamp(x, F.lit(f)), "yyyy-MM-dd") for f in ("M/d/yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")), x)


def date_of(x: Column | str) -> Column:
    """The date part of a timestamp's text."""
    return F.substring(F.substring_index(F.substring_index(blank_to_null(x), "T", 1), " ", 1), 1, 10)


def reconcile_dates(start: Column | str, latest: Column | str, lookback_days: int, today: Column) -> Column:
    """All days from the later of start and latest - lookback up to today; an empty array if there are none."""
    first = F.greatest(F.to_date(senate_date(start)), F.date_sub(F.try_to_date(senate_date(latest)), max(0, lookback_days)))
    return F.when(first <= today, F.sequence(first, today)).otherwise(F.array().cast("array<date>"))


def date_issue(transaction: Column | str, filing: Column | str, today: Column) -> Column:
    """missing, invalid, after_filing or future; null for a sound transaction date."""
    days = F.struct(F.try_to_date(_c(transaction), "yyyy-MM-dd").alias("t"), F.try_to_date(_c(filing), "yyyy-MM-dd").alias("f"))
    issue = lambda d: F.when(d["t"].isNull(), "invalid").when(d["t"] > d["f"], "after_filing").when(d["t"] > today, "future")
    return F.when(F.coalesce(_c(transaction), F.lit("")) == "", "missing").otherwise(bound(days, issue))


def retry_after(now: Column, attempts: Column, not_found: Column) -> Column:
    """When to try again: 15 minutes an attempt for what wasn't found, 10 otherwise, six hours at most."""
    minutes = F.least(F.when(not_found, 15).otherwise(10) * F.greatest(F.lit(1), attempts), F.lit(360))
    return now + F.make_dt_interval(mins=minutes)


def valid_on(end: Column | str, day: Column) -> Column:
    return _c(end).isNull() | (_c(end) >= day)


def stale(synced: Column | str, status: Column | str, now: Column, days: int, retry: tuple[str, ...] = ("error",)) -> Column:
    """Never synced, or last with a status to retry, or longer ago than ``days``."""
    return _c(synced).isNull() | F.coalesce(_c(status).isin(*retry), F.lit(False)) | (_c(synced) < now - F.make_dt_interval(days=F.lit(days)))

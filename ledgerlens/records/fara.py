"""Foreign-agent registrations: registrants, principals, short forms and documents out of API or bulk rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fara_date
from ..functions.hashing import sha1_key
from ..functions.text import normalize_name
from ..operators.fara import address
from .base import labelled, lines, pick, raw

_PLACE = {"address_1": ("ADDRESS_1", "Address 1"), "address_2": ("ADDRESS_2", "Address 2"), "city": ("CITY", "City"), "state": ("STATE", "State"), "zip_code": ("ZIP", "Zip")}


def _number(row: Column, *keys: str) -> Column:
    return F.coalesce(pick(row, *keys).try_cast("int"), F.lit(0))


def _or(x: Column, text: str, number: Column) -> Column:
    return F.coalesce(x, F.concat(F.lit(f"{text} "), number))


def registrants(rows: DataFrame, row: str = "row") -> DataFrame:
    r = F.col(row)
    number, day = _number(r, "Registration_Number", "Registration Number"), fara_date(pick(r, "Registration_Date", "Registration Date"))
    name = _or(pick(r, "Name", "Business Name"), "FARA registrant", number)
    place = address(*(r[k] for k in ("Address_1", "Address 1", "Address_2", "Address 2", "City", "State", "Zip")))
    content = lines(labelled("Registrant", name), labelled("Registration number", number), labelled("Registration date", F.coalesce(day, F.lit("Unknown"))), labelled("Address", F.coalesce(place, F.lit("Unknown"))))
    summary = F.concat(name, F.lit(" is an active FARA registrant under registration number "), number, F.lit("."))
    return rows.select(number.alias("registration_number"), name.alias("name"), normalize_name(name).alias("normalized_name"), day.alias("registration_date"), pick(r, "Address_1", "Address 1").alias("address_1"), pick(r, "Address_2", "Address 2").alias("address_2"),
                       pick(r, "City").alias("city"), pick(r, "State").alias("state"), pick(r, "Zip", "ZIP").alias("zip_code"), summary.alias("summary"), content.alias("content"), raw(r).alias("metadata"))


def principals(rows: DataFrame, row: str = "row") -> DataFrame:
    r = F.col(row)
    number, country = _number(r, "REG_NUMBER", "Registration Number"), pick(r, "COUNTRY_NAME", "Country/Location Represented")
    name, day = _or(pick(r, "FP_NAME", "Foreign Principal"), "Foreign principal", number), fara_date(pick(r, "FP_REG_DATE", "Foreign Principal Registration Date"))
    return rows.select(sha1_key(number, name, country, day).alias("principal_key"), number.alias("registration_number"), name.alias("foreign_principal_name"), normalize_name(name).alias("normalized_name"), _or(pick(r, "REGISTRANT_NAME", "Registrant Name"), "Registrant", number).alias("registrant_name"),
                       country.alias("country_name"), fara_date(pick(r, "REG_DATE", "Registrant Date")).alias("registration_date"), day.alias("foreign_principal_registration_date"), *(pick(r, *k).alias(c) for c, k in _PLACE.items()), raw(r).alias("metadata"))


def short_forms(rows: DataFrame, row: str = "row") -> DataFrame:
    r = F.col(row)
    number, day = _number(r, "REG_NUMBER", "Registration Number"), fara_date(pick(r, "SHORTFORM_DATE", "Short Form Date"))
    first, last = (F.coalesce(pick(r, f"SF_{a}_NAME", f"Short Form {b} Name"), F.lit("")) for a, b in (("FIRST", "First"), ("LAST", "Last")))
    full = _or(F.nullif(F.trim(F.concat_ws(" ", first, last)), F.lit("")), "Short form", number)
    return rows.select(sha1_key(number, full, day).alias("short_form_key"), number.alias("registration_number"), _or(pick(r, "REGISTRANT_NAME", "Registrant Name"), "Registrant", number).alias("registrant_name"), first.alias("first_name"), last.alias("last_name"), full.alias("full_name"),
                       normalize_name(full).alias("normalized_name"), day.alias("short_form_date"), fara_date(pick(r, "REG_DATE", "Registration Date")).alias("registration_date"), *(pick(r, *k).alias(c) for c, k in _PLACE.items()), raw(r).alias("metadata"))


def documents(rows: DataFrame, row: str = "row") -> DataFrame:
    r = F.col(row)
    number, kind = _number(r, "REGISTRATION_NUMBER", "Registration Number"), pick(r, "DOCUMENT_TYPE", "Document Type")
    day, url = fara_date(pick(r, "DATE_STAMPED", "Date Stamped")), F.coalesce(pick(r, "URL"), F.lit(""))
    return rows.select(sha1_key(number, kind, day, url).alias("document_key"), number.alias("registration_number"), _or(pick(r, "REGISTRANT_NAME", "Registrant Name"), "Registrant", number).alias("registrant_name"), F.coalesce(kind, F.lit("FARA filing")).alias("document_type"), day.alias("date_stamped"), url.alias("url"),
                       pick(r, "SHORT_FORM_NAME", "Short Form Name").alias("short_form_name"), pick(r, "FOREIGN_PRINCIPAL_NAME", "Foreign Principal Name").alias("foreign_principal_name"), pick(r, "FOREIGN_PRINCIPAL_COUNTRY", "Foreign Principal Country").alias("foreign_principal_country"), raw(r).alias("metadata"))


def page(registered: DataFrame, offset: int, limit: int, known: DataFrame | None = None) -> DataFrame:
    """One run's registrants, by number: those not stored yet, from ``offset`` on."""
    rows = registered.join(known.select("registration_number").distinct(), "registration_number", "left_anti") if known is not None else registered
    rows = rows.orderBy("registration_number", "name").offset(max(0, offset))
    return rows.limit(limit) if limit > 0 else rows

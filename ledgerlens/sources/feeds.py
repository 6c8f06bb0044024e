"""Readers of the public feeds, one function a feed.

Each takes a path (a file, a folder or a pattern) that holds what the feed delivered and gives its rows as they stand,
text in text columns; ``records`` makes typed records of them.  Rows of dumps whose columns vary are maps.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import feed_date
from ..functions.text import blank_to_null
from ..session import ship

ROWS = 10_000  # of a dump in one batch
PDF_BASE = "https://disclosures-clerk.house.gov/public_disc/ptr-pdfs"
OFFSHORE_FILES = {kind: f"nodes-{many}.csv" for kind, many in (("entity", "entities"), ("officer", "officers"), ("address", "addresses"), ("intermediary", "intermediaries"), ("other", "others"))}
_AWARDS = r"PrimeAwardSummaries"
_BULK = "Name|BioGuideID|Filed|Traded|Ticker|Company|Transaction|Trade_Size_USD|Amount|House|Chamber|State|Description|TickerType|Subholding|Comments|Representative|TransactionDate|ReportDate|QuiverUploadTime"
_LIVE = {"Senator": "Name", "BioGuideID": "BioGuideID", "Date": "Traded", "Ticker": "Ticker", "Transaction": "Transaction", "Range": "Trade_Size_USD", "Amount": "Amount", "last_modified": "Filed", "TickerType": "TickerType"}


def house_filings(spark: SparkSession, path: str, year: int, pdf_base: str = PDF_BASE) -> DataFrame:
    """Stubs of the periodic transaction reports in a year's XML index; a blank kind counts as one, other kinds go."""
    raw = spark.read.format("xml").option("rowTag", "Member").schema("DocID string, FilingType string, First string, Last string, StateDst string, FilingDate string").load(path)
    kind = F.upper(F.coalesce(blank_to_null("FilingType"), F.lit("PTR")))
    place = F.upper(blank_to_null("StateDst"))
    stubs = raw.select(
        blank_to_null("DocID").alias("doc_id"), F.lit(year).alias("filing_year"), kind.alias("filing_type"), feed_date("FilingDate").alias("filing_date"),
        blank_to_null("First").alias("first_name"), blank_to_null("Last").alias("last_name"), F.substring(place, 1, 2).alias("state"),
        F.nullif(F.expr("substring(upper(trim(StateDst)), 3)"), F.lit("")).alias("district"), blank_to_null("StateDst").alias("raw_state_district"))
    named = F.coalesce(F.nullif(F.concat_ws(" ", "first_name", "last_name"), F.lit("")), F.concat(F.lit("House PTR "), F.col("doc_id")))
    url = F.concat(F.lit(f"{pdf_base}/{year}/"), F.col("doc_id"), F.lit(".pdf"))
    return stubs.where("doc_id is not null and filing_type in ('P', 'PTR')").select("*", named.alias("member_name"), F.lit("house-clerk").alias("source"), url.alias("source_url"))


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, content) of landed reports; a file that isn't a PDF is left out."""
    files = spark.read.format("binaryFile").load(path)
    name = F.regexp_extract("path", r"([^/]+)\.pdf$", 1)
    return files.select(name.alias("doc_id"), "content").where((F.col("doc_id") != "") & F.substring("content", 1, 4).eqNullSafe(F.lit(b"%PDF")))


def _text(names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names.split("|"))


def senate_watcher(spark: SparkSession, path: str) -> DataFrame:
    """The aggregate of Senate trades, one JSON array; every field may be missing."""
    return spark.read.json(path, multiLine=True, schema=_text("transaction_date|owner|ticker|asset_description|asset_type|type|amount|comment|senator|ptr_link"))


def congress_bulk(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages of the bulk feed of congressional trades; rows that several pages repeat come once."""
    return spark.read.json(path, multiLine=True, schema=_text(_BULK)).distinct()


def senate_live(spark: SparkSession, path: str) -> DataFrame:
    """The live Senate feed in the bulk feed's columns."""
    raw = spark.read.json(path, multiLine=True, schema=_text("|".join(_LIVE)))
    here = {new: F.col(old) for old, new in _LIVE.items()} | {"House": F.lit("Senate"), "TickerType": F.coalesce(F.col("TickerType"), F.lit("Stock"))}
    return raw.select(*(here.get(c, F.lit(None).cast("string")).alias(c) for c in _BULK.split("|")))


def zipped_csv(spark: SparkSession, path: str, entries: str = r"\.csv$", encoding: str = "utf-8", without: str | None = None, only_first: bool = False) -> DataFrame:
    """(file, entry, line, row): rows of CSV entries in zip archives, as maps from stripped headers to text.

    An archive is read by one task, as a stream of its rows.  Cells beyond the header go, missing ones are empty,
    bytes that the encoding lacks are skipped.
    """
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    names = [n for n in archive.namelist() if re.search(entries, n, re.I) and not (without and re.search(without, n, re.I))]
                    for name in names[:1] if only_first else names:
                        with archive.open(name) as handle:
                            rows = csv.DictReader(io.TextIOWrapper(handle, encoding, errors="ignore", newline=""))
                            held: list[tuple] = []
                            for n, r in enumerate(rows):
                                held.append((file, name, n, [((k or "").strip(), v or "") for k, v in r.items() if k is not None]))
                                if len(held) == ROWS:
                                    yield batch(held, kind)
                                    held = []
                            if held:
                                yield batch(held, kind)

    def batch(held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        file, entry, line, row = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(file), pa.array(entry), pa.array(line, pa.int64()), pa.array(row, kind)], ["file", "entry", "line", "row"])
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, entry string, line long, row map<string,string>")


def fara_bulk(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the registration unit's zipped bulk files, the first CSV of each."""
    return zipped_csv(spark, path, encoding="ISO-8859-1", only_first=True)


def fara_api(spark: SparkSession, path: str, *steps: str) -> DataFrame:
    """(row): what answers of the registration API hold at a path of keys, whether a list, one row, or none."""
    whole = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$" + "".join(f"['{s}']" for s in steps)).alias("x"))
    inner = F.get_json_object("x", "$.ROW")
    rows = F.when(F.col("x").startswith("["), F.col("x")).when(inner.startswith("["), inner).when(inner.startswith("{"), F.concat(F.lit("["), inner, F.lit("]")))
    each = whole.select(F.explode(F.from_json(rows, "array<string>")).alias("x")).where(F.col("x").startswith("{"))
    return each.select(F.from_json("x", "map<string,string>").alias("row"))


def _first_lines(rows: DataFrame, limit: int) -> DataFrame:
    if limit <= 0:
        return rows
    at = F.row_number().over(Window.partitionBy("entry").orderBy("file", "line"))
    return rows.where(F.col("line") < limit).withColumn("_at", at).where(F.col("_at") <= limit).drop("_at")


def offshore_nodes(spark: SparkSession, path: str, kinds: list[str] | None = None, limit: int = 0) -> DataFrame:
    """(node_type, row) of the leaks archive's node files; ``limit``, if positive, holds for each type."""
    named = {OFFSHORE_FILES[k]: k for k in kinds or OFFSHORE_FILES}
    rows = _first_lines(zipped_csv(spark, path, "|".join(re.escape(n) + "$" for n in named)), limit)
    kind = F.create_map(*(F.lit(x) for kv in named.items() for x in kv))[F.element_at(F.split("entry", "/"), -1)]
    return rows.select(kind.alias("node_type"), "row")


def offshore_links(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    return _first_lines(zipped_csv(spark, path, r"(^|/)relationships\.csv$"), limit).select("row")


def award_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the prime award summaries in downloaded archives; sub-awards are left out."""
    return zipped_csv(spark, path, _AWARDS, "utf-8-sig", without="Subawards")


def json_results(spark: SparkSession, path: str, schema: str, field: str = "results") -> DataFrame:
    """The objects in a list field of landed JSON answers (recipients, agencies, bills, filings), as ``schema`` has them.

    Pages are separate files; a file without the field gives none.
    """
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.explode(F.from_json(F.get_json_object("value", f"$.{field}"), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def json_object(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """One object from each landed JSON answer, whole or in a field."""
    pages = spark.read.text(path, wholetext=True)
    x: Column = F.get_json_object("value", f"$.{field}") if field else F.col("value")
    return pages.select(F.from_json(x, schema).alias("r")).where("r is not null").select("r.*")


def member_registry(spark: SparkSession, path: str) -> DataFrame:
    """Members from the registry's JSON list; anything else than a list is an error."""
    first = spark.read.text(path, wholetext=True).select(F.substring(F.ltrim("value"), 1, 1).alias("c")).where("c <> '['").first()
    if first is not None:
        raise ValueError("the registry isn't a list")
    return spark.read.json(path, multiLine=True, schema=_text("id|bioguide_id|name|slug|party|state|district|chamber|first_name|last_name"))


def write_registry(members: DataFrame, path: str) -> None:
    members.write.mode("overwrite").json(path)


def not_yet_read(files: DataFrame, results: DataFrame, content: str = "content", digest: str = "file_hash") -> DataFrame:
    """Files, with the SHA-256 of their content, that no stored result has."""
    return files.withColumn(digest, F.sha2(content, 256)).join(results.select(digest).where(F.col(digest).isNotNull()).distinct(), digest, "left_anti")

"""What is due: extraction queues, ingestion filters, missing pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import pick_per_key

NOT_THERE, MANUAL = "PTR PDF fetch failed with 404", "PTR text extracted but transactions need manual review"
_FIRST = ("pending_extraction", "extracting", "needs_review")


def error_begins(text: str) -> Column:
    """Whether the last error of a row's metadata begins with a text, in any case."""
    return F.coalesce(F.get_json_object("metadata", "$.lastError"), F.lit("")).ilike(f"{text}%")


def due(queue: DataFrame, now: Column, limit: int, review: str = "no") -> DataFrame:
    """Rows of (doc_id, status, metadata, detected_at) to extract next.

    ``review`` "no" leaves rows for review out, "too" takes them along, "only" takes just them, whenever they are to
    be tried again; else a row waits for its retryAfter.  What a report's server hasn't got isn't asked for again.
    """
    status = F.col("status")
    if review == "only":
        ready = (status == "needs_review") | ((status == "pending_extraction") & error_begins(MANUAL))
    else:
        at = F.try_to_timestamp(F.nullif(F.get_json_object("metadata", "$.retryAfter"), F.lit("")))
        ready = status.isin(*_FIRST[: 3 if review == "too" else 2]) & (at.isNull() | (at <= now))
    rank = F.when(status == _FIRST[0], 0).when(status == _FIRST[1], 1).when(status == _FIRST[2], 2).otherwise(3)
    gone = (status == "pending_extraction") & error_begins(NOT_THERE)
    return queue.where(ready & ~gone).orderBy(rank, F.desc_nulls_last("detected_at"), "doc_id").limit(max(1, limit))


def fresh(rows: DataFrame, key: str, stored: DataFrame, day: str | None = None, start: str | None = None, *order: Column) -> DataFrame:
    """Rows from no earlier than ``start`` (those without a day count) whose key isn't stored, each key once."""
    rows = rows.where(F.col(day).isNull() | (F.col(day) >= start)) if day and start else rows
    return pick_per_key(rows.join(stored.select(key).distinct(), key, "left_anti"), [key], *(order or (F.asc(key),)))


def with_outcome(queue: DataFrame, tries: DataFrame, now: Column) -> DataFrame:
    """The queue after extractions (doc_id, trades, member_id, confidence, error): status and what the metadata tells.

    A failure that may pass counts an attempt and says when to try again; one for review says why.
    """
    from ..functions.collections import merge_json
    from ..functions.dates import retry_after
    from ..rules.codes import outcome

    t = tries.select(F.col("doc_id").alias("_doc"), "confidence", "trades", "error", outcome(F.col("trades"), F.col("member_id"), F.col("confidence"), F.col("error")).alias("_status"))
    q = queue.join(t, F.col("doc_id") == F.col("_doc"), "left")
    attempts = F.coalesce(F.get_json_object("metadata", "$.attempts").try_cast("int"), F.lit(0)) + 1
    again = F.col("_status") == "pending_extraction"
    wait = F.when(again, F.date_format(retry_after(now, attempts, F.col("error").contains("404")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    why = F.coalesce("error", F.when((F.col("_status") == "needs_review") & (F.coalesce("trades", F.lit(0)) == 0), F.lit(MANUAL)), F.lit(""))
    news = F.to_json(F.struct(attempts.alias("attempts"), F.coalesce(wait, F.lit("")).alias("retryAfter"), why.alias("lastError"), F.col("confidence").alias("parserConfidence"), F.col("trades").alias("parsedTransactionCount")))
    return q.select(*(F.coalesce("_status", "status").alias(c) if c == "status" else F.when(F.col("_doc").isNotNull(), merge_json("metadata", news)).otherwise(F.col("metadata")).alias(c) if c == "metadata" else F.col(c) for c in queue.columns))


def until_refused(answers: DataFrame, order: str = "seq", status: str = "http_status") -> DataFrame:
    """Answers up to the first that says too many requests: what came after isn't trusted."""
    stop = answers.where(F.col(status) == 429).agg(F.min(order).alias("_stop"))
    return answers.join(F.broadcast(stop)).where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def quarantined(rows: DataFrame, *needed: str) -> tuple[DataFrame, DataFrame]:
    """(sound, bad): rows that lack what is needed go aside, with what they lack."""
    lacks = F.array_compact(F.array(*(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in needed)))
    told = rows.withColumn("lacks", lacks)
    return told.where(F.size("lacks") == 0).drop("lacks"), told.where(F.size("lacks") > 0)

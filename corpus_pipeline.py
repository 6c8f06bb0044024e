"""From raw documents to packed training windows: STAGES in order, each over all that the one before kept.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs.
Columns beyond those of documents pass through; null ids and texts stay until packing, which leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import minhash, packing, secrets, toxicity
from ledgerlens.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples make them toxic go.

    Null and empty texts are judged like texts without neighbours, long ones whole, repeated rows each.  Without
    labels of both kinds, and of an empty table, all stay.
    """
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id.

    Null and empty texts are like nothing and stay; of rows that repeat an id one stays; rows without an id stay.
    """
    return minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked and n_chars follows the text."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which tokens of which document fill each training window, related documents side by side."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("minhash", drop_near_duplicates), ("secrets", mask_secrets), ("packing", pack_windows)]

# SQL expresses none of the four methods; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

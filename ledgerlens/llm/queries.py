"""Queries that apply each operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, egojoin, imatch, lm, minhash, packing, rangecoder, secrets, sharding, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangecoder.write(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op3_embedding_dedup": egojoin.ORACLE, "op5_imatch": imatch.ORACLE, "op9_sharding": sharding.oracle()}

"""Documents into a searchable store: chunks, embeddings, and the queue of what still lacks one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..functions.text import _c
from .chunk import chunk_rows
from .store import replace_children, update_by_key, upsert

Embedder = Callable[[Column], Column]
INHERITED = ["title", "source", "category", "document_date", "member_ids", "committee_ids", "bill_ids", "asset_tickers"]


def hashed(dim: int = 256) -> Embedder:
    """An embedder without a model: signed counts of hashed words, of unit length; the same everywhere and always."""
    def embed(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            v = np.zeros(dim, np.float64)
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
                v[h % dim] += 1 if h >> 63 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32).tolist() if t is not None else None)
        return pa.array(out, pa.list_(pa.float32()))
    udf = F.arrow_udf(embed, ArrayType(FloatType()))
    return lambda x: udf(_c(x))


EMBEDDERS: dict[str, Callable[..., Embedder] | None] = {"none": None, "hashed": hashed}


def embedder(name: str = "none", **how) -> Embedder | None:
    """A registered provider's embedder; None for "none", after which search is lexical only."""
    if name not in EMBEDDERS:
        raise ValueError(f"no embedder is named {name}")
    make = EMBEDDERS[name]
    return make(**how) if make else None


def index(documents: DataFrame, chunks: DataFrame, records: DataFrame, embed: Embedder | None, now: Column, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(documents, chunks) after records have been added or written anew.

    A record that is known by its source_document_id keeps the id it had, and its chunks are named after that.  All
    chunks of touched documents make way, also where a text has none left; without an embedder theirs are null.
    """
    after = upsert(documents, records, ["source_document_id"], seq, now, keep=("id",))
    touched = after.join(records.select("source_document_id").distinct(), "source_document_id", "left_semi")
    new = chunk_rows(touched, "id", "content", [c for c in INHERITED if c in touched.columns])
    new = new.withColumn("embedding", embed(F.col("content")) if embed else F.lit(None).cast("array<float>"))
    return after, replace_children(chunks, new.select(chunks.columns), touched.select(F.col("id").alias("document_id")), "document_id")


def lacking(chunks: DataFrame) -> DataFrame:
    """Chunks with a text and without an embedding."""
    return chunks.where(F.col("embedding").isNull() & (F.coalesce(F.trim("content"), F.lit("")) != ""))


def drain(chunks: DataFrame, embed: Embedder | None, batch: int, most: int = 0, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, dict]:
    """(chunks, summary) after batches of embeddings, until none is lacking, ``most`` are done, or one gets nowhere.

    ``keep`` stores the table between batches, so that each starts from files.
    """
    done, rounds, left = 0, 0, lacking(chunks).count()
    while left and (not most or rounds < most):
        now = lacking(chunks).orderBy("id").limit(max(1, batch)).select("id", "content")
        new = now.select("id", embed(F.col("content")).alias("embedding")) if embed else now.select("id", F.lit(None).cast("array<float>").alias("embedding"))
        chunks = keep(update_by_key(chunks, new, "id", "embedding"))
        rounds, before = rounds + 1, left
        left = lacking(chunks).count()
        done += before - left
        if left == before:
            break
    return chunks, {"batches": rounds, "embedded": done, "left": left}

"""Documents to overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import _c, strip_ws, token_estimate

SIZE, OVERLAP, FLOOR = 3_200, 800, 800


def paragraphs(x: Column | str) -> Column:
    """Parts between blank lines, trimmed; none for blank texts."""
    x = strip_ws(F.regexp_replace(F.replace(F.coalesce(_c(x), F.lit("")), F.lit("\r\n"), F.lit("\n")), r"\n{3,}", "\n\n"))
    return F.filter(F.transform(F.split(x, r"\n(?U)\s*\n"), strip_ws), lambda p: p != "")


def windows(p: Column, size: int, overlap: int) -> Column:
    """A long paragraph in windows of ``size`` characters, each begun ``overlap`` before the last one's end."""
    step = max(1, size - overlap)
    last = F.ceil((F.length(p) - size) / step).cast("int")
    return F.filter(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: strip_ws(F.substring(p, i * step + 1, F.lit(size)))), lambda w: w != "")


def chunks(x: Column | str, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Paragraphs packed into chunks of at most ``size`` characters; only longer paragraphs are cut, with overlap.

    A fold over the paragraphs with the finished chunks and the one being filled; sizes under 800 count as 800.
    """
    size = max(FLOOR, size)
    overlap = max(0, min(overlap, size // 2))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(s: Column, p: Column) -> Column:
        longer = F.when(s["open"] == "", p).otherwise(F.concat(s["open"], F.lit("\n\n"), p))
        closed = F.when(s["open"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))
        return (F.when(F.length(longer) <= size, F.struct(s["done"].alias("done"), longer.alias("open")))
                .when(F.length(p) <= size, F.struct(closed.alias("done"), p.alias("open")))
                .otherwise(F.struct(F.concat(closed, windows(p, size, overlap)).alias("done"), F.lit("").alias("open"))))
    return F.aggregate(paragraphs(x), start, add, lambda s: F.when(s["open"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))


def chunk_rows(docs: DataFrame, doc_id: str = "id", content: str = "content", keep: list[str] | None = None, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(id, document_id, chunk_index, content, token_estimate, ...): one row a chunk with what it inherits."""
    keep = keep or []
    rows = docs.select(doc_id, *keep, F.posexplode(chunks(content, size, overlap)).alias("chunk_index", "_chunk"))
    return rows.select(F.concat(F.col(doc_id).cast("string"), F.lit(":chunk:"), F.col("chunk_index")).alias("id"), F.col(doc_id).alias("document_id"), "chunk_index", F.col("_chunk").alias("content"), token_estimate("_chunk").alias("token_estimate"), *keep)

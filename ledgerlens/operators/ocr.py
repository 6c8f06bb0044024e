"""Readings of scanned files: back ends as plug-ins, the choice among their readings, page confidences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import text_confidence
from .relational import pick_per_key

Reader = Callable[[bytes], list[str]]  # a file's content to its pages' texts; raises if it can't
_BACKENDS: dict[str, Reader] = {}
AUTO = ("pymupdf", "surya", "docling")  # in the order they are tried; what costs much isn't in it


def register(name: str, reader: Reader) -> None:
    _BACKENDS[name] = reader


def plain_text(content: bytes) -> list[str]:
    """The reader of text files: pages are parted by form feeds."""
    return content.decode("utf-8").split("\f")


register("text", plain_text)


def read(files: DataFrame, backends: tuple[str, ...], key: str = "doc_id") -> DataFrame:
    """(key, backend, rank, pages, error): each file by each back end, in their order; a failure is a row of its own."""
    chosen = [(b, _BACKENDS.get(b)) for b in backends]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for own, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for rank, (name, reader) in enumerate(chosen):
                    pages, error = None, None
                    try:
                        if reader is None:
                            raise RuntimeError("the back end isn't installed")
                        pages = reader(content)
                    except Exception as x:  # one file's failure is that file's result
                        error = str(x)
                    rows.append((own, name, rank, pages, error))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.string()))], [key, "backend", "rank", "pages", "error"])
    return files.select(F.col(key).cast("string").alias(key), "content").mapInArrow(run, f"{key} string, backend string, rank int, pages array<string>, error string")


def with_confidence(readings: DataFrame, pages: str = "pages", threshold: float = 0.6) -> DataFrame:
    """text, confidence (the mean of the pages'), page_confidences and low_pages (numbered from 1) of each reading."""
    r = readings.withColumn("page_confidences", F.coalesce(F.transform(pages, text_confidence), F.array().cast("array<double>")))
    n = F.size("page_confidences")
    mean = F.when(n == 0, 0.0).otherwise(F.bround(F.aggregate("page_confidences", F.lit(0.0), lambda a, x: a + x) / n, 4))
    low = F.filter(F.transform("page_confidences", lambda x, i: F.when(x < threshold, i + 1)), lambda x: x.isNotNull())
    return r.withColumns({"text": F.coalesce(F.array_join(pages, "\n\n"), F.lit("")), "confidence": mean, "low_pages": low})


def first_good(readings: DataFrame, key: str = "doc_id", threshold: float = 0.6) -> DataFrame:
    """One reading a file: the first in order that reaches the threshold, else the one of the highest confidence.

    Empty texts aren't readings; a file without any is left out.
    """
    passed: Column = F.col("confidence") >= threshold
    return pick_per_key(readings.where(F.coalesce(F.trim("text"), F.lit("")) != ""), [key], F.desc(passed), F.asc(F.when(passed, F.col("rank"))), F.desc("confidence"), F.asc("rank"))

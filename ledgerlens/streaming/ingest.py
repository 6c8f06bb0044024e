"""Incremental ingestion: deduplicated windows, a retrying queue as a state machine, and drains of what is there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.relational import pick_per_key
from ..rules.codes import outcome
from ..session import scratch, ship

LATE = "14 days"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The table's files as a stream, event time as a timestamp; the table may be one file or a folder."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]").withColumn("ts", F.col("ts").cast("timestamp"))  # a pattern, so that Spark takes a file too


def drain(stream: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    """All that is there now, run to the end; the last value of each key, as a written table.

    A batch that is run again after a failure writes the same folder again, so nothing counts twice.
    """
    spark = stream.sparkSession
    out, state = scratch(spark), scratch(spark)

    def write(df: DataFrame, batch: int) -> None:
        df.withColumn("_batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    schema = stream.schema.add("_batch", IntegerType())
    return pick_per_key(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out), keys, F.desc("_batch")).drop("_batch")


def windowed_counts(events: DataFrame, late: str = LATE, width: str = "1 day") -> DataFrame:
    """Events counted by day and type, each id once, as late as ``late`` behind the newest."""
    once = events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    return once.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


PENDING, PARSED = "pending_extraction", "parsed"


def queue_states(tries: DataFrame, key: str = "user_id", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """(key, status, retries, attempts): each key's state after its extractions, in order within a batch.

    ``tries`` has trades, member_id, confidence and error.  What is parsed stays parsed; else the last try counts.
    """
    ship(tries.sparkSession)
    told = tries.select(key, *order, outcome(F.col("trades"), F.col("member_id"), F.col("confidence"), F.col("error")).alias("outcome"))

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, retries, attempts = state.get if state.exists else (PENDING, 0, 0)
        got = pd.concat(frames).sort_values([*order])["outcome"]
        retries, attempts = int(retries + (got == PENDING).sum()), int(attempts + len(got))
        status = PARSED if status == PARSED or (got == PARSED).any() else got.iloc[-1] if len(got) else status
        state.update((status, retries, attempts))
        yield pd.DataFrame({key: [k[0]], "status": [status], "retries": [retries], "attempts": [attempts]})
    return told.groupBy(key).applyInPandasWithState(step, f"{key} long, status string, retries long, attempts long", "status string, retries long, attempts long", "update", GroupStateTimeout.NoTimeout)

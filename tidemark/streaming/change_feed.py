"""Change feeds over append-only tables: batch cursors, streams, and stateful supersede by idempotent batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.latest import latest_per_group


def changes_after(feed: DataFrame, cursor: int | None = None, after_seq: int | None = None, limit: int = 100) -> DataFrame:
    """One page of a feed in order of seq; a cursor goes before ``after_seq``."""
    start = cursor if cursor is not None else after_seq
    return (feed if start is None else feed.where(F.col("seq") > start)).orderBy("seq").limit(limit)


def follow(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """A stream of what is appended to a parquet folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Handle all that is there now, batch by batch, and stop. The checkpoint makes the next call go on from there."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def keep_newest(state: DataFrame | None, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """State after a batch of an overlapping re-read: the newest row per key, rows with codes first.

    Applying a batch twice changes nothing, so a replayed batch is harmless.
    """
    rows = batch if state is None else state.unionByName(batch)
    coded = F.coalesce(F.trim("codes"), F.lit("")) != ""
    return latest_per_group(rows.distinct(), [key], [coded.desc(), *[F.desc(c) for c in order]])


def newest_state_writer(spark: SparkSession, folder: str, key: str, order: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch handler that keeps versions of the state under ``folder``: batch n reads n - 1 and overwrites n."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = spark.read.parquet(f"{folder}/{batch_id - 1}") if batch_id else None
        keep_newest(state, batch, key, order).write.mode("overwrite").parquet(f"{folder}/{batch_id}")

    return handle


def event_counts(stream: DataFrame, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Events by type and tumbling window, late ones up to ``delay``; the watermark bounds the state."""
    timed = stream.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    return timed.groupBy(F.window("event_time", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), "event_type", "n")


def sequence(events: DataFrame, order: list[str], after: int = 0) -> DataFrame:
    """Number new events after the last seq; one writer appends a publication's events at a time."""
    return events.withColumn("seq", F.lit(after) + F.row_number().over(W.orderBy(*order)))

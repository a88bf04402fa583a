"""Ingest positions: one high-water mark per event source.

The table only grows by one row per save; the latest row per source is its position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.dates import utc_text
from reviewmill.operators.counts import high_water_mark
from reviewmill.operators.dedupe import latest_per_key
from reviewmill.schemas import POSITIONS


def position_rows(events: DataFrame, source: str, **columns: str) -> DataFrame:
    """The position record of a source after the given events; none if there are no events."""
    marks = high_water_mark(events, **columns).where(F.col("enqueued_time").isNotNull())
    kind = marks.schema["enqueued_time"].dataType.simpleString()
    return marks.select(
        F.lit(source).alias("event_source"),
        utc_text(F.col("enqueued_time"), kind).alias("enqueued_time"),
        utc_text(F.current_timestamp(), "timestamp").alias("last_modification"),
        F.col("max_offset").cast("bigint").alias("max_offset"),
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
    )


def save_position(events: DataFrame, path: str, source: str, **columns: str) -> None:
    position_rows(events, source, **columns).coalesce(1).write.mode("append").parquet(path)


def observed_marks(events: DataFrame, name: str = "position") -> DataFrame:
    """The events, which also report their high-water mark to whoever writes them."""
    kind = events.schema["enqueuedTime"].dataType.simpleString()
    return events.observe(
        name,
        utc_text(F.max("enqueuedTime"), kind).alias("enqueued_time"),
        F.max("offset").cast("bigint").alias("max_offset"),
        F.max("sequenceNumber").cast("bigint").alias("sequence_number"),
    )


def save_observed(spark: SparkSession, marks: Sequence[Mapping], path: str, source: str) -> int:
    """Store the position after the batches whose marks are given, at least the one stored so far.

    Batches without events have no mark. Returns the number of those that had.
    """
    found = [m for m in marks if m["enqueued_time"] is not None]
    if not found:
        return 0
    if _saved(spark, path):
        found += latest_positions(spark, path).where(F.col("event_source") == source).collect()
    most = {c: max((m[c] for m in found if m[c] is not None), default=None) for c in ("enqueued_time", "max_offset", "sequence_number")}
    row = spark.createDataFrame([(source, *most.values())], "event_source string, enqueued_time string, max_offset long, sequence_number long")
    row = row.withColumn("last_modification", utc_text(F.current_timestamp(), "timestamp"))
    row.select(*POSITIONS.names).coalesce(1).write.mode("append").parquet(path)
    return len([m for m in marks if m["enqueued_time"] is not None])


def latest_positions(spark: SparkSession, path: str) -> DataFrame:
    """One row per source, the last one saved."""
    saved = spark.read.schema(POSITIONS).parquet(path)
    return latest_per_key(
        saved, "event_source", "last_modification", tiebreak=["sequence_number", "enqueued_time"]
    )


def _saved(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def stored_position(spark: SparkSession, path: str, source: str) -> str | None:
    """Enqueue time saved for a source in UTC; None if nothing was saved yet."""
    if not _saved(spark, path):
        return None
    row = latest_positions(spark, path).where(F.col("event_source") == source).first()
    return row["enqueued_time"] if row else None

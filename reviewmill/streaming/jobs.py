"""Bronze and silver event streams. Both are stateless, so no state store is needed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from reviewmill.plans.bronze import bronze_events
from reviewmill.plans.silver import silver_events
from reviewmill.sources.positions import observed_marks, save_observed, save_position, stored_position
from reviewmill.sources.readers import from_position, stream_table
from reviewmill.sources.writers import stream_append

# Files per micro-batch, interval of a running stream, longest run of a scheduled one.
FILES_PER_TRIGGER = 2500
STREAM_INTERVAL = "30 seconds"
RUN_SECONDS = 300


def run_until_done(writer: DataStreamWriter, seconds: float = RUN_SECONDS) -> bool:
    """Run a stream until it has caught up or the time is over, then stop it.

    True if it caught up. What is left is read by the next run from the checkpoint.
    """
    query = writer.start()
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def run_to_end(make_writer: Callable[[], DataStreamWriter], seconds: float = RUN_SECONDS) -> int:
    """Run a stream again and again until it has caught up; returns the number of runs."""
    runs = 1
    while not run_until_done(make_writer(), seconds):
        runs += 1
    return runs


def stream_bronze_events(
    events: DataFrame,
    table: str,
    checkpoint: str,
    *,
    position: str | None = None,
    interval: str | None = None,
) -> DataStreamWriter:
    """Streamed event envelopes to the bronze table, partitioned by UTC day.

    The checkpoint alone is exact; a position is for a stream that starts a new one.
    """
    rows = bronze_events(from_position(events, position))
    return stream_append(rows, table, checkpoint, "date_utc", interval)


def run_bronze_with_position(
    spark: SparkSession,
    events: DataFrame,
    table: str,
    checkpoint: str,
    positions: str,
    source: str,
    *,
    position: str | None = None,
    seconds: float = RUN_SECONDS,
) -> bool:
    """Stream envelopes into bronze until caught up, and store the position from what the writes have seen.

    The high-water mark of each micro-batch comes with its progress, so nothing is read again. A run that is killed before the
    position is stored leaves the older one, which the next start passes over by its checkpoint. True if it caught up.
    """
    rows = observed_marks(bronze_events(from_position(events, position)))
    query = stream_append(rows, table, checkpoint, "date_utc").start()
    try:
        done = bool(query.awaitTermination(seconds))
    finally:
        query.stop()
    marks = [p["observedMetrics"].get("position") for p in query.recentProgress if p.get("observedMetrics")]
    save_observed(spark, [m.asDict() if hasattr(m, "asDict") else m for m in marks if m], positions, source)
    return done


def stream_silver_events(
    spark: SparkSession,
    bronze: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    *,
    interval: str | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataStreamWriter:
    """Bronze events to the silver table, with the cleaning that batch runs use."""
    events = stream_table(spark, bronze, schema, files_per_trigger)
    return stream_append(silver_events(events), table, checkpoint, "date_utc", interval)


def save_daily_position(spark: SparkSession, bronze: str, positions: str, source: str) -> None:
    """Scheduled task: store the high-water mark of the bronze events.

    Only the days from the last stored position on are read.
    """
    events = spark.read.parquet(bronze)
    stored = stored_position(spark, positions, source)
    if stored:
        first = F.lit(stored[:10]).cast(events.schema["date_utc"].dataType)
        events = events.where(F.col("date_utc") >= first)
    save_position(events, positions, source)

"""One stream in two tables: events that parse, and those that do not with a reason and their position.

Both tables are partitioned by day and micro-batch. A micro-batch that runs again after a failure reads the same events and
replaces its own partitions, so each event ends in exactly one of the tables, once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from reviewmill.plans.silver import silver_events

#: Columns of an event that say where it is in its source; those that the feed has are kept.
POSITION = ("partition", "offset", "sequenceNumber", "enqueuedTime", "date_utc")


def body_fault(body: Column, required: tuple[str, ...] = ("asin",)) -> Column:
    """Why an event's body cannot be used; null if it can."""
    parsed = F.try_parse_json(body)
    fault = F.when(body.isNull() | (F.trim(body) == ""), "no body").when(parsed.isNull(), "not json")
    fault = fault.when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), "not an object")
    for field in required:
        value = F.try_variant_get(parsed, f"$.{field}", "string")
        fault = fault.when(value.isNull() | (F.trim(value) == ""), f"no {field}")
    return fault


def split_events(events: DataFrame, required: tuple[str, ...] = ("asin",)) -> tuple[DataFrame, DataFrame]:
    """Bronze events that can be used, and the others as (reason, body, position)."""
    judged = events.withColumn("reason", body_fault(F.col("body"), required))
    position = [c for c in POSITION if c in events.columns]
    good = judged.where(F.col("reason").isNull()).drop("reason")
    return good, judged.where(F.col("reason").isNotNull()).select("reason", "body", *position)


def stream_split_events(
    events: DataFrame,
    table: str,
    quarantine: str,
    checkpoint: str,
    *,
    clean: Callable[[DataFrame], DataFrame] = silver_events,
    required: tuple[str, ...] = ("asin",),
    interval: str | None = None,
) -> DataStreamWriter:
    """Bronze events to a clean table and a quarantine, both partitioned by ``date_utc`` and ``batch``."""

    def put(rows: DataFrame, batch: int) -> None:
        good, bad = split_events(rows, required)
        for part, path in ((clean(good), table), (bad, quarantine)):
            named = part.withColumn("batch", F.lit(batch).cast("long"))
            writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("date_utc", "batch").parquet(path)

    writer = events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)

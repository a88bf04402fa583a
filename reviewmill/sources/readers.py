"""Batch and stream readers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.functions.dates import parse_moment
from reviewmill.sources.evolution import stored_schema


def read_json(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """JSON rows of one or many folders in one scan.

    With a schema, unknown fields are dropped and absent ones null. Without one Spark reads
    the data once more to infer it, over all folders together, so their types agree.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(paths if isinstance(paths, str) else list(paths))


def list_folders(spark: SparkSession, root: str, start: int = 0) -> list[str]:
    """Sub-folders of a folder in name order, from the ``start``-th on. Hidden ones are skipped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    folders = sorted(
        s.getPath().toString()
        for s in statuses
        if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))
    )
    return folders[start:]


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Columnar table in the schema stored with it; without one, ``merge_schema`` gathers columns that later appends added."""
    stored = stored_schema(spark, path)
    if stored is not None:
        return spark.read.schema(stored).parquet(path)
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A table or folder as a stream; the file limit bounds each micro-batch at the source."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def kafka_options(
    servers: str, topic: str, group: str, position: str | None = None
) -> dict[str, str]:
    """Options of Spark's Kafka source: consumer group, and the start as a UTC time or the beginning.

    They hold for a new checkpoint; an old one goes on where it stopped.
    """
    start = {"startingOffsets": "earliest"}
    if position is not None:
        start = {"startingTimestamp": str(int(parse_moment(position).timestamp() * 1000))}
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.group.id": group, **start}


def kafka_envelope(messages: DataFrame) -> DataFrame:
    """Messages of Spark's Kafka source in the shape of the event feed."""
    return messages.select(
        F.col("value").alias("body"),
        F.col("offset").cast("string").alias("offset"),
        F.col("offset").alias("sequenceNumber"),
        F.col("timestamp").alias("enqueuedTime"),
    )


def start_position(
    stored: str | None, manual: str | None = None, from_beginning: bool = False
) -> str | None:
    """Where to start: a time given by hand, else the stored one; None is the whole stream."""
    if from_beginning:
        return None
    return (manual or "").strip() or stored


def moment_column(position: str | dt.datetime, kind: str) -> Column:
    """A time, UTC unless it says otherwise, as a literal of a timestamp type."""
    if isinstance(position, str):
        position = parse_moment(position)
    elif position.tzinfo is None:
        position = position.replace(tzinfo=dt.timezone.utc)
    utc = position.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if kind == "timestamp_ntz":
        return F.lit(utc.isoformat(" ")).cast("timestamp_ntz")
    micros = (utc - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def from_position(
    events: DataFrame, position: str | dt.datetime | None, moment: str = "enqueuedTime"
) -> DataFrame:
    """Events enqueued at or after the position, UTC unless it says otherwise. The time itself is read again.

    Text is parsed here, before any event is read: a position that cannot be read raises.
    """
    if position is None:
        return events
    start = moment_column(position, events.schema[moment].dataType.simpleString())
    return events.where(F.col(moment) >= start)


def without_repeats(
    events: DataFrame, delay: str, moment: str = "enqueuedTime", keys: Sequence[str] = ("source", "offset")
) -> DataFrame:
    """Each event once, for a stream that reads its start position again; off unless a job asks for it.

    Keys are remembered for ``delay`` after their event time, which bounds the state.
    """
    return events.withWatermark(moment, delay).dropDuplicatesWithinWatermark(list(keys))

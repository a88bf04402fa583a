"""Table writers.

Partitioned writes first rebalance on the partition key: small partitions end in few
files, and a hot one is split over many tasks instead of filling one. That shuffles whole rows, more bytes
than the table has in the end, so large feeds are written with ``spread=False``: each task writes the rows it has, with one
file a partition open at once. Such a table has more and smaller files; ``layout.compact`` merges them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from reviewmill.session import DROP_SHUFFLES, scratch_path, settings_for

# Records per file of the two batch feeds, and their folders per write.
METADATA_RECORDS_PER_FILE = 1_000_000
REVIEW_RECORDS_PER_FILE = 500_000
FOLDERS_PER_WRITE = 100
#: Codec of the tables: about half the bytes of the default one on reviews.
COMPRESSION = "zstd"
#: Files that a task holds open at once; rows of further partitions are sorted first.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "200"}
#: Input of a task at most, if that leaves one for each core: a task with few rows would write small files. Rows that come from a
#: shuffle may be sorted for a join first, which has to fit the task's memory.
LARGE_TASKS = {
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "256k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
}


def _writer(dataframe: DataFrame, by: str | None, max_records: int | None, spread: bool = True):
    writer = (dataframe.hint("rebalance", by) if by and spread else dataframe).write
    if by:
        writer = writer.partitionBy(by)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    return writer.option("compression", COMPRESSION)


def _settings(dataframe: DataFrame, spread: bool = True):
    settings = DROP_SHUFFLES if spread else {**DROP_SHUFFLES, **OPEN_FILES, **LARGE_TASKS}
    return settings_for(dataframe.sparkSession, settings)


def append_table(
    dataframe: DataFrame, path: str, by: str | None = None, max_records: int | None = None, *, spread: bool = True
) -> None:
    """Append rows; columns the table lacks are added, and read with ``merge_schema``.

    Where types may move as well, ``ledger.grow_table`` keeps one schema for all files.
    """
    with _settings(dataframe, spread):
        _writer(dataframe, by, max_records, spread).mode("append").parquet(path)


def overwrite_table(
    dataframe: DataFrame, path: str, by: str | None = None, max_records: int | None = None, *, spread: bool = True
) -> None:
    """Replace the whole table."""
    writer = _writer(dataframe, by, max_records, spread).option("partitionOverwriteMode", "static")
    with _settings(dataframe, spread):
        writer.mode("overwrite").parquet(path)


def overwrite_partitions(dataframe: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that the rows belong to."""
    writer = _writer(dataframe, by, None).option("partitionOverwriteMode", "dynamic")
    with _settings(dataframe):
        writer.mode("overwrite").parquet(path)


def replace_day(dataframe: DataFrame, path: str, day: dt.date, by: str = "date") -> int:
    """Replace one day of a table and keep the rest; return the day's row count.

    The rows are written once to the scratch folder and checked there, so that costly
    columns are computed once and a row of another day stops the run before the table
    changes. A day without rows is emptied.
    """
    spark = dataframe.sparkSession
    staged_path = scratch_path(spark, "replace-day")
    dataframe.write.parquet(staged_path)
    staged = spark.read.schema(dataframe.schema).parquet(staged_path)

    is_day = F.col(by).eqNullSafe(F.lit(day).cast(dataframe.schema[by].dataType))
    found = staged.agg(F.count("*").alias("rows"), F.count_if(~is_day).alias("foreign")).first()
    if found["foreign"]:
        raise ValueError(f"{found['foreign']} rows are not of {by} = {day}")
    if found["rows"]:
        overwrite_partitions(staged, path, by)
    else:
        staged.drop(by).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{by}={day}")
    return found["rows"]


def publish_table(dataframe: DataFrame, name: str, mode: str = "errorifexists", **options) -> None:
    """Publish as a named table of the session catalog: create it, or ``mode="append"``."""
    dataframe.write.mode(mode).options(**options).saveAsTable(name)


def publish_day(dataframe: DataFrame, name: str, day: dt.date, by: str = "date", **options) -> None:
    """Publish one day, replacing it on a rerun, so that no day is ever appended twice."""
    spark = dataframe.sparkSession
    rows = dataframe.where(F.col(by) == F.lit(day))
    if not spark.catalog.tableExists(name):
        rows.write.partitionBy(by).options(**options).saveAsTable(name)
        return
    unknown = [c for c in rows.columns if c not in spark.table(name).columns]
    if unknown:
        raise ValueError(f"{name} has no column {', '.join(unknown)}: add it to the table first")
    # Naming the partition replaces that one alone, and empties it if there are no rows.
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != by)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (`{by}` = DATE '{day}') "
        f"SELECT {columns} FROM {{rows}}",
        rows=rows,
    )


def stream_append(
    stream: DataFrame, path: str, checkpoint: str, by: str | None = None, interval: str | None = None
) -> DataStreamWriter:
    """A checkpointed append to a table: every ``interval``, or once over all there is."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if by:
        writer = writer.partitionBy(by)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)

"""An index of the times that a table's files hold, so that a start position opens only the files it needs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.sources.readers import from_position, moment_column
from reviewmill.sources.storage import Store

SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"
SCHEMA = "file string, rows long, earliest {kind}, latest {kind}"


def _index_path(table: str, moment: str) -> str:
    return f"{table.rstrip('/')}/_index/{moment}"


def read_index(spark: SparkSession, table: str, moment: str, kind: str) -> DataFrame:
    """One row (file, rows, earliest, latest) per indexed file that is still there."""
    path = _index_path(table, moment)
    if not Store(spark, table).exists(path):
        return spark.createDataFrame([], SCHEMA.format(kind=kind))
    return spark.read.schema(SCHEMA.format(kind=kind)).parquet(path).dropDuplicates(["file"])


def index_files(spark: SparkSession, table: str, schema: StructType, moment: str = "enqueuedTime") -> int:
    """Index the files that are not indexed yet and return their number: one column of each is read, once."""
    kind = schema[moment].dataType.simpleString()
    known = read_index(spark, table, moment, kind)
    there = _files(spark, table)
    new = sorted(r.file for r in there.join(known, "file", "left_anti").collect())
    if new:
        at = F.col(f"`{moment}`")
        rows = spark.read.schema(schema).option("basePath", table).parquet(*(f"{table.rstrip('/')}/{name}" for name in new))
        measured = rows.select(F.col("_metadata.file_path").alias("path"), at.alias("at")).groupBy("path").agg(
            F.count("*").alias("rows"), F.min("at").alias("earliest"), F.max("at").alias("latest")
        )
        # A file's address is encoded, and may name a host that the table's path leaves out.
        plain = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), SCHEME, "")
        start = len(re.sub(SCHEME, "", Store(spark, table).name)) + 2
        measured = measured.withColumn("file", F.substring(plain, start, 1 << 20))
        listed = spark.createDataFrame([(name,) for name in new], "file string")
        empty = F.coalesce("rows", F.lit(0).cast("long")).alias("rows")
        named = listed.join(measured, "file", "left").select("file", empty, "earliest", "latest")
        named.coalesce(1).write.mode("append").parquet(_index_path(table, moment))
    return len(new)


def _files(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([(name,) for name in Store(spark, table).walk(table)], "file string")


def read_from(
    spark: SparkSession, table: str, schema: StructType, position: str | None, moment: str = "enqueuedTime"
) -> DataFrame:
    """Rows of a table at or after a position; files whose latest time is before it are not opened.

    Files that are not indexed are read, so the result is the same with an old index or none.
    """
    if position is None:
        return spark.read.schema(schema).parquet(table)
    kind = schema[moment].dataType.simpleString()
    index = read_index(spark, table, moment, kind)
    before = index.where(F.coalesce(F.col("latest") < moment_column(position, kind), F.lit(True)))
    wanted = sorted(r.file for r in _files(spark, table).join(before, "file", "left_anti").collect())
    if not wanted:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", table).parquet(*(f"{table.rstrip('/')}/{name}" for name in wanted))
    return from_position(rows, position, moment)

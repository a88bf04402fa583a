"""Bronze tables: the feeds as they come, with neat names, a date and the source file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.functions.dates import (
    day_text,
    extract_date_from_string,
    extract_year,
    extract_year_month,
    unix_to_date,
)
from reviewmill.functions.names import snake_name
from reviewmill.functions.text import decode_bytes, text_to_long
from reviewmill.operators.columns import add_file_source_column, get_formatted_column_names
from reviewmill.schemas import METADATA
from reviewmill.sources.evolution import feed_schema
from reviewmill.sources.ledger import Ledger, load_folders
from reviewmill.sources.readers import read_json
from reviewmill.sources.writers import (
    FOLDERS_PER_WRITE,
    METADATA_RECORDS_PER_FILE,
    REVIEW_RECORDS_PER_FILE,
)


def bronze_metadata(raw: DataFrame) -> DataFrame:
    """Raw product metadata with ``parsed_date``, ``file_source`` and its ``year``."""
    dated = extract_date_from_string(get_formatted_column_names(raw), "date")
    return extract_year(add_file_source_column(dated), "parsed_date").withColumnsRenamed(
        {"parsed_date_year": "year"}
    )


def bronze_reviews(raw: DataFrame) -> DataFrame:
    """Raw reviews with ``unix_review_time_date``, ``file_source`` and their ``year_month``."""
    dated = unix_to_date(get_formatted_column_names(raw), "unix_review_time")
    return extract_year_month(
        add_file_source_column(dated), "unix_review_time_date"
    ).withColumnsRenamed({"unix_review_time_date_year_month": "year_month"})


def bronze_events(events: DataFrame) -> DataFrame:
    """Event envelopes with a text body, a numeric offset and their UTC day."""
    return events.withColumns(
        {
            "body": decode_bytes(F.col("body")),
            "offset": text_to_long(F.col("offset")),
            "date_utc": day_text(F.col("enqueuedTime")),
        }
    )


def load_bronze_metadata(
    spark: SparkSession,
    folders: Sequence[str],
    table: str,
    per_write: int | None = FOLDERS_PER_WRITE,
    progress: Callable[[int, int], None] | None = None,
) -> int:
    """Append the metadata folders that the bronze table lacks, partitioned by year."""
    return load_folders(
        spark,
        folders,
        lambda session, paths: bronze_metadata(read_json(session, paths, METADATA)),
        table,
        "year",
        METADATA_RECORDS_PER_FILE,
        per_write,
        progress,
    )


def load_bronze_reviews(
    spark: SparkSession,
    folders: Sequence[str],
    table: str,
    per_write: int | None = FOLDERS_PER_WRITE,
    schema: StructType | None = None,
    progress: Callable[[int, int], None] | None = None,
) -> int:
    """Append the review folders that the bronze table lacks, partitioned by month.

    A schema keeps its own fields only. Without one every raw field is kept: types are inferred once over all folders to
    load, as wide as the table has them already, and all writes share them. Where new folders need a wider type
    than the table has, its older partitions are rewritten.
    """
    if schema is None:
        ledger = Ledger(spark, table)
        ledger.recover()
        pending = ledger.pending(folders)
        if not pending:
            return 0
        schema = feed_schema(spark, read_json(spark, pending).schema, table, snake_name)
    return load_folders(
        spark,
        folders,
        lambda session, paths: bronze_reviews(read_json(session, paths, schema)),
        table,
        "year_month",
        REVIEW_RECORDS_PER_FILE,
        per_write,
        progress,
    )

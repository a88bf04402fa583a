"""Counts per value, key, month, hour and event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.dates import month_start, year_start


def count_by(dataframe: DataFrame, *keys: str) -> DataFrame:
    """Rows per key combination, unordered."""
    return dataframe.groupBy(*keys).agg(F.count("*").alias("n"))


def value_frequency(dataframe: DataFrame, *columns: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value; ``top`` keeps the head only."""
    ordered = count_by(dataframe, *columns).orderBy(F.desc("n"), *columns)
    return ordered.limit(top) if top is not None else ordered


def row_count(dataframe: DataFrame) -> DataFrame:
    return dataframe.agg(F.count("*").alias("n"))


def count_by_month(dataframe: DataFrame, day: str) -> DataFrame:
    return dataframe.groupBy(month_start(F.col(day)).alias("month")).agg(F.count("*").alias("n"))


def count_by_year(dataframe: DataFrame, day: str) -> DataFrame:
    return dataframe.groupBy(year_start(F.col(day)).alias("year")).agg(F.count("*").alias("n"))


def time_parts(dataframe: DataFrame, moment: str) -> DataFrame:
    """Add the date, hour and minute of an event time."""
    at = F.col(moment)
    return dataframe.withColumns({"date": F.to_date(at), "hour": F.hour(at), "minute": F.minute(at)})


def count_by_hour(dataframe: DataFrame, moment: str) -> DataFrame:
    """Events per date and hour, in time order."""
    return count_by(time_parts(dataframe, moment), "date", "hour").orderBy("date", "hour")


def count_by_time(dataframe: DataFrame, moment: str) -> DataFrame:
    """Events per event time, newest first."""
    return count_by(dataframe, moment).orderBy(F.desc(moment))


def high_water_mark(
    dataframe: DataFrame,
    *,
    sequence: str = "sequenceNumber",
    offset: str = "offset",
    moment: str = "enqueuedTime",
    by: str | None = None,
) -> DataFrame:
    """Greatest sequence number, offset and time, each on its own, overall or per source."""
    grouped = dataframe.groupBy(by) if by else dataframe.groupBy()
    return grouped.agg(
        F.max(sequence).alias("sequence_number"),
        F.max(offset).alias("max_offset"),
        F.max(moment).alias("enqueued_time"),
    )

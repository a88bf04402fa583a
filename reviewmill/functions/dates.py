"""Date parts and parsing. Parsers return null on bad text in both ANSI modes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the feeds and of the partition keys.
YEAR_MONTH = "yyyy-MM"
YEAR = "yyyy"
DAY = "yyyy-MM-dd"
LONG_DATE = "MMMM d, yyyy"
INSTANT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

SECONDS_PER_DAY = 86400


def unix_date(seconds: Column) -> Column:
    """UTC date of Unix seconds, whatever the session time zone is; null beyond the days of an int."""
    return F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).try_cast("int"))


def year_month_text(day: Column) -> Column:
    return F.date_format(day, YEAR_MONTH)


def year_text(day: Column) -> Column:
    return F.date_format(day, YEAR)


def day_text(moment: Column) -> Column:
    """Partition day of an event time (UTC sessions, or zone-free timestamps)."""
    return F.date_format(moment, DAY)


def long_date(text: Column) -> Column:
    """Dates such as ``July 1, 2014``; anything else is null."""
    return F.try_to_date(text, LONG_DATE)


def instant(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` read as a UTC instant in any session time zone."""
    return F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit(INSTANT + "X"))


def utc_text(moment: Column, kind: str) -> Column:
    """``INSTANT`` text in UTC of a ``timestamp``, whatever the session time zone is, or of a ``timestamp_ntz``."""
    if kind == "timestamp":
        start = F.lit("1970-01-01").cast("timestamp_ntz")
        seconds = (F.unix_micros(moment).cast("decimal(38,6)") / F.lit(1_000_000)).cast("decimal(18,6)")
        moment = start + F.make_dt_interval(secs=seconds)
    return F.date_format(moment, INSTANT)


def parse_moment(text: str) -> dt.datetime:
    """A UTC moment written as a date, or with seconds, a fraction, or an offset; raises on anything else."""
    try:
        moment = dt.datetime.fromisoformat(text.strip())
    except ValueError:
        raise ValueError(f"{text!r} is not a moment such as 2024-01-31 or 2024-01-31 12:00:00.5") from None
    return moment.replace(tzinfo=moment.tzinfo or dt.timezone.utc).astimezone(dt.timezone.utc)


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def year_start(day: Column) -> Column:
    return F.trunc(day, "year")


def default_run_date(now: dt.datetime | None = None) -> dt.date:
    """Yesterday in UTC, the day a daily job works on unless told otherwise."""
    moment = now or dt.datetime.now(dt.timezone.utc)
    return moment.date() - dt.timedelta(days=1)


def _with_date_part(dataframe: DataFrame, column_name: str, suffix: str, part) -> DataFrame:
    if column_name not in dataframe.columns:
        raise ValueError(f"Column '{column_name}' not found in DataFrame.")
    source = F.col(f"`{column_name}`")
    if dataframe.schema[column_name].dataType.typeName() == "string":
        source = source.try_cast("date")
    return dataframe.withColumn(f"{column_name}_{suffix}", part(source))


def unix_to_date(dataframe: DataFrame, column_name: str) -> DataFrame:
    """Add ``<column>_date`` from Unix seconds."""
    seconds = F.col(f"`{column_name}`").try_cast("bigint")
    return dataframe.withColumn(f"{column_name}_date", unix_date(seconds))


def extract_year_month(dataframe: DataFrame, column_name: str) -> DataFrame:
    """Add ``<column>_year_month`` as ``yyyy-MM`` text."""
    return _with_date_part(dataframe, column_name, "year_month", year_month_text)


def extract_year(dataframe: DataFrame, column_name: str) -> DataFrame:
    """Add ``<column>_year`` as ``yyyy`` text."""
    return _with_date_part(dataframe, column_name, "year", year_text)


def extract_date_from_string(dataframe: DataFrame, column_name: str, pattern: str = LONG_DATE) -> DataFrame:
    """Add ``parsed_date``; text that does not fit the pattern gives null."""
    return dataframe.withColumn("parsed_date", F.try_to_date(F.col(f"`{column_name}`"), pattern))

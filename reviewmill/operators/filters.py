"""Filters that keep the partition column typed, so that pruning and pushdown work."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_year(dataframe: DataFrame, year: int, column: str = "year") -> DataFrame:
    """Rows of a year or later, for a partition kept as text."""
    return dataframe.where(F.col(column).try_cast("int") >= year)


def on_day(
    dataframe: DataFrame,
    day: dt.date,
    date_column: str = "date",
    month_column: str | None = "year_month",
) -> DataFrame:
    """Rows of one day; the month condition prunes the partitions of a monthly table."""
    rows = dataframe
    if month_column:
        rows = rows.where(F.col(month_column) == F.lit(day.replace(day=1)))
    return rows.where(F.col(date_column) == F.lit(day))

"""Unions of feeds."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from reviewmill.operators.columns import conform


def union_all(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """All rows of all frames by column name, duplicates kept.

    Frames with other columns raise; with ``allow_missing`` an absent column is null.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_feeds(schema: StructType, *feeds: DataFrame, optional: Iterable[str] = ()) -> DataFrame:
    """Union of feeds whose types differ, each brought to one declared schema first."""
    return union_all(*(conform(feed, schema, optional) for feed in feeds))

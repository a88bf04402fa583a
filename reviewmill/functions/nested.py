"""Arrays, structs and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.functions.text import swap

# Markers and patterns of the rank and image fields.
BAD_IMAGE = "88"
RANK_MARK = ">#"
RANK_NUMBER = r"(\d{1,3}(?:,\d{3})*)"
RANK_CATEGORY = r"in\s+(.+)"
RANK_JOINER = ", "
UNKNOWN = "Unknown"


def json_list(value: Column) -> Column:
    """JSON text to an array of text; malformed text is null."""
    return F.from_json(value, "array<string>")


def json_struct(value: Column, schema: StructType | str) -> Column:
    """JSON text to a struct by declared schema; malformed text gives null fields."""
    return F.from_json(value, schema)


def without(items: Column, value: str) -> Column:
    return F.array_remove(items, value)


def null_if_empty(items: Column) -> Column:
    """Null instead of an empty array; ``nullif`` works its argument out once."""
    return F.nullif(items, F.array().cast("array<string>"))


def image_links(value: Column) -> Column:
    """Image list from JSON text without the corrupt entry; an empty list is null."""
    return null_if_empty(without(json_list(value), BAD_IMAGE))


def first_item(items: Column) -> Column:
    """First element, null for an empty or null array in both ANSI modes."""
    return F.get(items, F.lit(0))


def first_or_unknown(items: Column) -> Column:
    return F.coalesce(first_item(items), F.lit(UNKNOWN))


def rank_entries(value: Column) -> Column:
    """Rank JSON text to an array of {number, cat}; a part that does not match is ``''``."""

    def entry(item: Column) -> Column:
        plain = swap(item, (RANK_MARK, ""))
        return F.struct(
            F.regexp_extract(plain, RANK_NUMBER, 1).alias("number"),
            F.regexp_extract(plain, RANK_CATEGORY, 1).alias("cat"),
        )

    return F.transform(json_list(value), entry)


def rank_summary(entries: Column) -> Column:
    """{higher_rank, cat}: the least rank number in text order, and all categories."""
    return F.struct(
        F.array_min(entries.getField("number")).alias("higher_rank"),
        F.concat_ws(RANK_JOINER, entries.getField("cat")).alias("cat"),
    )


def best_rank(entries: Column) -> Column:
    """The least rank as a number, which text order does not give (``1,234`` < ``2``)."""
    return F.array_min(
        F.transform(entries.getField("number"), lambda n: swap(n, (",", "")).try_cast("bigint"))
    )

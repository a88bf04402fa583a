"""Text clean-up: entities, titles, categories, prices, words and keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities, markers and patterns found in the raw feeds.
AMPERSAND = ("&amp;", "&")
QUOTE = ("&quot;", '"')
IMAGE_MARK = "img src="
ALT_TEXT = r"""alt=["']([^"']*)"""
TAG_START = "<"
TAG_END = '" />'
EMPTY_OBJECT = "{}"
NOT_PRICE = r"[^0-9.]"
WORD_GAP = r"\s+"


def swap(value: Column, pair: tuple[str, str]) -> Column:
    """Literal replacement; ``replace`` needs no regular expression engine."""
    found, instead = pair
    return F.replace(value, F.lit(found), F.lit(instead))


def decode_ampersand(value: Column) -> Column:
    return swap(value, AMPERSAND)


def decode_entities(value: Column) -> Column:
    """``&amp;`` first, then ``&quot;``, so a doubly escaped quote is decoded too."""
    return swap(decode_ampersand(value), QUOTE)


def null_if(value: Column, *junk: str) -> Column:
    """Null instead of any of the given texts."""
    return F.when(~value.isin(*junk), value)


def null_if_starts(value: Column, start: str) -> Column:
    return F.when(~value.startswith(start), value)


def is_missing_text(value: Column) -> Column:
    return value.isNull() | value.isin(EMPTY_OBJECT, "")


def clean_category(value: Column) -> Column:
    """Category name: the ``alt`` text of an image tag, decoded, words capitalised."""
    named = F.when(value.contains(IMAGE_MARK), F.regexp_extract(value, ALT_TEXT, 1)).otherwise(value)
    return F.initcap(decode_ampersand(named))


def clean_title(value: Column) -> Column:
    """Product title without tag rests; titles that are a tag, or empty, become null."""
    kept = null_if(null_if_starts(value, TAG_START), "")
    return decode_ampersand(F.replace(kept, F.lit(TAG_END), F.lit("")))


def price_to_float(value: Column) -> Column:
    """Digits and dots as a 32-bit float; a range or an empty price is null."""
    return F.regexp_replace(value, NOT_PRICE, "").try_cast("float")


def word_count(value: Column) -> Column:
    """Pieces between blanks; empty text counts 1, null text is null in both ANSI modes."""
    return F.when(value.isNotNull(), F.size(F.split(value, WORD_GAP)))


def one_word(value: Column, words: Column) -> Column:
    """The text itself when it is a single word."""
    return F.when(words == 1, value)


def decode_bytes(value: Column) -> Column:
    return value.cast("string")


def text_to_long(value: Column) -> Column:
    return value.try_cast("bigint")

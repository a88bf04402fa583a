"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space is these six characters everywhere; other Unicode spaces belong to words.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """Words between white space, as an array; empty for a text without a word."""
    bare = trimmed(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unused(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no given column has it, whatever its case."""
    lowered = {column.lower() for column in taken}
    while name.lower() in lowered:
        name = f"_{name}"
    return name

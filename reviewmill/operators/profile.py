"""Data-quality profiles, each in one pass over the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from reviewmill.functions.text import is_missing_text


def _share(condition: Column) -> Column:
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def missing_tests(dataframe: DataFrame) -> list[tuple[str, str, Column]]:
    """Name, type and missing-value test of every text or array column."""
    tests = []
    for column in dataframe.schema.fields:
        value = F.col(f"`{column.name}`")
        if isinstance(column.dataType, StringType):
            tests.append((column.name, column.dataType.simpleString(), is_missing_text(value)))
        elif isinstance(column.dataType, ArrayType):
            tests.append((column.name, column.dataType.simpleString(), F.size(value) == 0))
    return tests


def missing_share(dataframe: DataFrame) -> DataFrame:
    """Share of missing values per text or array column, worst first.

    Text is missing when null, ``{}`` or empty; an array when it is empty. Nulls are also
    given apart, since an array can be null without being empty.
    """
    measures = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            _share(missing).alias("missing_share"),
            _share(F.col(f"`{name}`").isNull()).alias("null_share"),
        )
        for name, kind, missing in missing_tests(dataframe)
    ]
    if not measures:
        raise ValueError("no text or array column to profile")
    return (
        dataframe.agg(F.array(*measures).alias("measures"))
        .select(F.inline("measures"))
        .orderBy(F.desc("missing_share"), "column_name")
    )


def _long_form(dataframe: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One (column_name, value) row per column, so that many columns count in one scan."""
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), value.cast("string").alias("value"))
            for name, value in columns.items()
        )
    )
    return dataframe.select(F.inline(pairs))


def partition_key_profile(dataframe: DataFrame, candidates: dict[str, Column]) -> DataFrame:
    """How each candidate key would cut the table: groups, largest, mean, and their ratio."""
    groups = _long_form(dataframe, candidates).groupBy("column_name", "value").agg(
        F.count("*").alias("n")
    )
    return groups.groupBy("column_name").agg(
        F.count("*").alias("groups"),
        F.max("n").alias("largest_group"),
        F.avg("n").alias("mean_group"),
        (F.max("n") / F.avg("n")).alias("skew"),
    )


def frequencies(dataframe: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of several columns at once, most frequent first."""
    return (
        _long_form(dataframe, {name: F.col(f"`{name}`") for name in columns})
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
        .orderBy("column_name", F.desc("n"), "value")
    )


def column_overview(dataframe: DataFrame) -> list[tuple[str, str]]:
    """Names and types of the columns."""
    return dataframe.dtypes


#: Values that the sketch of frequent values follows, and the logarithm of the size of the distinct-count sketch.
FREQUENT_VALUES = 8192
DISTINCT_BITS = 14


def partition_key_sketch(
    dataframe: DataFrame, candidates: dict[str, Column], values: int = FREQUENT_VALUES, bits: int = DISTINCT_BITS
) -> DataFrame:
    """The profile of candidate keys from sketches: one row of sketches a task is shuffled, however many values there are.

    ``groups`` has a relative standard error of ``groups_error``; it is exact for a few dozen values. ``largest_group`` is at most
    ``largest_error`` rows off, and exact while a key has fewer than three quarters of ``values`` values. ``partition_key_profile`` is the
    exact form. Null is a value of its own, as there.
    """
    missing, present = "0", "1"  # marks in front, so that a null is no text
    marked = {
        f"k{i}": F.when(value.isNull(), missing).otherwise(F.concat(F.lit(present), value.cast("string")))
        for i, value in enumerate(candidates.values())
    }
    sketched = dataframe.select(*(value.alias(name) for name, value in marked.items())).agg(
        F.count("*").alias("n"),
        *(F.hll_sketch_estimate(F.hll_sketch_agg(name, bits)).alias(f"{name}_groups") for name in marked),
        *(F.expr(f"approx_top_k({name}, 1, {values})").alias(f"{name}_top") for name in marked),
    )
    error = 1.04 / math.sqrt(2**bits)
    figures = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"k{i}_groups").alias("groups"),
            F.lit(error).alias("groups_error"),
            F.get(f"k{i}_top", F.lit(0))["count"].alias("largest_group"),
            F.when(F.col(f"k{i}_groups") < 0.75 * values, F.lit(0))
            .otherwise(F.ceil(3.5 * F.col("n") / values))
            .cast("long")
            .alias("largest_error"),
            (F.col("n") / F.col(f"k{i}_groups")).alias("mean_group"),
        )
        for i, name in enumerate(candidates)
    ]
    rows = sketched.where("n > 0").select(F.inline(F.array(*figures)))
    return rows.withColumn("skew", F.col("largest_group") / F.col("mean_group"))

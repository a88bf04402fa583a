"""Compaction and clustering of Parquet tables into a new folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType


def _read(spark: SparkSession, path: str, by: str | None) -> DataFrame:
    """A table whose partition values stay the text of their folders: ``007`` is not 7."""
    if not by:
        return spark.read.parquet(path)
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != by]
    return spark.read.schema(StructType([*fields, StructField(by, StringType())])).parquet(path)


def _checked(spark: SparkSession, source: str, target: str, by: str | None = None) -> DataFrame:
    before, after = spark.read.parquet(source).count(), spark.read.parquet(target).count()
    if before != after:
        raise RuntimeError(f"{source} has {before} rows but {target} has {after}")
    return _read(spark, target, by)


def compact(
    spark: SparkSession, source: str, target: str, by: str | None = None, files: int | None = None
) -> DataFrame:
    """Rewrite a table into fewer files and return it; row counts are compared.

    A partitioned table is rebalanced on its partition key, which merges small
    partitions and splits large ones by measured size; else ``files`` even files are written.
    The partition values come back as the text of their folders.
    """
    rows = _read(spark, source, by)
    if by:
        writer = rows.hint("rebalance", by).write.partitionBy(by)
    else:
        writer = (rows.repartition(files) if files else rows.hint("rebalance")).write
    writer.mode("overwrite").parquet(target)
    return _checked(spark, source, target, by)


def cluster(spark: SparkSession, source: str, target: str, key: str, files: int) -> DataFrame:
    """Rewrite a table sorted by one key, so that a filter on the key skips most files.

    The row's place in its file is the second range key: a hot key spreads over as
    many ranges as it needs, and the result is the same if a task runs again.
    """
    rows = spark.read.parquet(source).select("*", F.col("_metadata.row_index").alias("_place"))
    ranged = rows.repartitionByRange(files, key, "_place").sortWithinPartitions(key, "_place")
    ranged.drop("_place").write.mode("overwrite").parquet(target)
    return _checked(spark, source, target)


def _ordered_number(column: Column, kind) -> Column:
    """A number that orders like the value; texts by their first seven bytes."""
    if isinstance(kind, (NumericType, BooleanType)):
        return column.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"a {kind.simpleString()} cannot be a key of the curve")


def curve_place(ranks: Sequence[Column], bits: int) -> Column:
    """The place on a Z-shaped curve: the bits of all ranks in turn, the highest first."""
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for turn, rank in enumerate(reversed(ranks)):
            own = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(own, bit * len(ranks) + turn))
    return place


def cluster_by_curve(
    spark: SparkSession, source: str, target: str, keys: Sequence[str], files: int, bits: int = 8
) -> DataFrame:
    """Rewrite a table along a space-filling curve over several keys, so that a filter on any of them skips most files.

    Keys are scaled by rank: a quantile sketch of each, all in one pass, gives ``2 ** bits`` steps of about as many
    rows, however a key's values are spread. Nulls are the lowest step. Rows of one step stay in order of their place in the
    source, so a hot value spreads over as many files as it needs.
    """
    if not 1 <= len(keys) * bits <= 62:
        raise ValueError("the ranks of all keys must fit 62 bits")
    rows = spark.read.parquet(source)
    kinds = {key: rows.schema[key].dataType for key in keys}
    steps = 2**bits
    shares = [step / steps for step in range(1, steps)]
    numbers = rows.select(*(_ordered_number(F.col(f"`{key}`"), kinds[key]).alias(f"k{i}") for i, key in enumerate(keys)))
    cuts = numbers.agg(*(F.percentile_approx(f"k{i}", shares, 100 * steps).alias(f"k{i}") for i in range(len(keys)))).first()

    def rank(i: int, key: str) -> Column:
        """How many cuts are at or below the value, by halving."""
        bounds = F.lit(sorted(cuts[i] or [0.0] * (steps - 1)))
        value = _ordered_number(F.col(f"`{key}`"), kinds[key])
        halves = F.array(*(F.lit(2**bit) for bit in reversed(range(bits))))
        found = F.aggregate(
            halves, F.lit(0), lambda at, half: F.when(F.get(bounds, at + half - 1) <= value, at + half).otherwise(at)
        )
        return F.when(value.isNull(), 0).otherwise(found).cast("long")

    place = curve_place([F.col(f"_rank{i}") for i in range(len(keys))], bits)
    ranked = rows.select("*", F.col("_metadata.row_index").alias("_place"))
    ranked = ranked.withColumns({f"_rank{i}": rank(i, key) for i, key in enumerate(keys)}).withColumn("_curve", place)
    ranged = ranked.repartitionByRange(files, "_curve", "_place").sortWithinPartitions("_curve", "_place")
    ranged.select(*(F.col(f"`{c}`") for c in rows.columns)).write.mode("overwrite").parquet(target)
    return _checked(spark, source, target)

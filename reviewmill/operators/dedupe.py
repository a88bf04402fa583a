"""Latest row per key, and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import DROP_SHUFFLES, keep, settings_for

#: Hashes of repeated rows that are broadcast at most; with more, all rows are compared.
MOST_REPEATED = 1_000_000


def latest_per_key(
    dataframe: DataFrame,
    keys: str | Sequence[str],
    latest: str,
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the latest by ``latest`` (null counts as oldest).

    Rows that tie are told apart by ``tiebreak``, largest first, else by a hash of the whole row,
    so a rerun keeps the same row. The filter on the row number lets Spark cut each
    map task to one row per key before the shuffle, so a hot key costs one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ties = [F.col(c) if isinstance(c, str) else c for c in tiebreak]
    if not ties:
        ties = [F.xxhash64(*(F.col(f"`{c}`") for c in dataframe.columns))]
    order = [F.col(latest).desc_nulls_last(), *(t.desc_nulls_last() for t in ties)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return dataframe.withColumn("_place", place).where("_place = 1").drop("_place")


def top_per_key(
    dataframe: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """The first k rows per key, with their place; cut per map task in the same way."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return dataframe.withColumn("place", place).where(F.col("place") <= k)


def distinct_rows(dataframe: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over the given columns only, or over all.

    Copies meet in the map-side aggregation, so a large group of copies is not shuffled whole.
    """
    rows = dataframe.select(*columns) if columns else dataframe
    return rows.dropDuplicates()


def once_and_several(
    dataframe: DataFrame, columns: Sequence[str], most: int = MOST_REPEATED
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows that no other row equals in ``columns``, and the rest, so that only the rest need be compared whole.

    Only a hash of these columns is shuffled, with its count; the few that come more than once are kept as a table and broadcast.
    A side without rows to look for is None; where more than ``most`` hashes are repeated, all rows are in the rest.
    """
    row_hash = F.xxhash64(F.lit(0), *(F.col(f"`{c}`") for c in columns))
    counted = dataframe.groupBy(row_hash.alias("_hash")).agg(F.count("*").alias("_rows"))
    with settings_for(dataframe.sparkSession, DROP_SHUFFLES):
        repeated = keep(counted.where("_rows > 1").select("_hash"), "repeated")
    found = repeated.count()
    if not found:
        return dataframe, None
    if found > most:
        return None, dataframe
    same = row_hash == F.col("_hash")
    return tuple(dataframe.join(F.broadcast(repeated), same, how) for how in ("left_anti", "left_semi"))

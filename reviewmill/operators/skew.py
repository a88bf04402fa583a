"""Left join that spreads hot keys over many tasks, by sizes that were counted before.

Adaptive execution splits hot partitions too, but only where both sides come straight from
a shuffle, and only where it is switched on. Salting by known sizes needs neither.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

# A key is hot above this many rows, or above this share of all rows where that is more.
HOT_ROWS = 1_000_000
MOST_HOT_KEYS = 100_000


def hot_keys(
    sizes: DataFrame, key: str, rows: str = "rows", hot_rows: int = HOT_ROWS
) -> DataFrame | None:
    """Keys with too many rows for one task, and over how many salts to spread each.

    ``sizes`` is a table of rows per key. The null key counts like any other: its rows match nothing but
    have to go somewhere. One summary row comes to the driver; None says that no key is hot. A hot key holds more than
    1 / ``MOST_HOT_KEYS`` of all rows, so there are fewer of them than that: few enough to
    broadcast however large the table is.
    """
    summary = sizes.agg(F.sum(rows).alias("total"), F.max(rows).alias("largest")).first()
    limit = max(hot_rows, (summary["total"] or 0) / MOST_HOT_KEYS)
    if (summary["largest"] or 0) <= limit:
        return None
    spread = F.ceil(F.col(rows) / limit).cast("int")
    hot = sizes.where(F.col(rows) > limit)
    return hot.select(key, spread.alias("_salts"))


def left_join_by_size(
    left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None
) -> DataFrame:
    """The left join on ``key``; if there are hot keys, the null key among them, their rows are spread.

    Spread rows go by a hash of the row, and each right row of a hot key is repeated once per salt.
    The salt depends on the row alone, so a task that runs again sends its rows the same way.
    Copies of one row share a salt: remove them first, as gold does, or leave them to adaptive
    execution, which can split here, as the salt puts both sides behind a shuffle.
    """
    if hot is None:
        return left.join(right, key, "left")
    hot = F.broadcast(hot.withColumnRenamed(key, "_hot"))
    row_hash = F.xxhash64(
        *(F.col(f"`{f.name}`") for f in left.schema if not isinstance(f.dataType, MapType))
    )
    salt = F.coalesce(F.pmod(row_hash, F.col("_salts")), F.lit(0)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    salted = left.join(hot, is_hot, "left").withColumn("_salt", salt).drop("_salts", "_hot")
    repeated = right.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salts).drop("_salts", "_hot")
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")

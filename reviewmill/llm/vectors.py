"""Helpers for vector columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True where the vector is there and all its entries are finite numbers."""
    infinite = F.lit(math.inf)

    def finite(entry: Column) -> Column:
        number = entry.cast("double")
        return entry.isNotNull() & ~F.isnan(number) & (F.abs(number) != infinite)

    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as the rows of a matrix; shorter ones are padded with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if width and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    starts = np.cumsum(lengths) - lengths
    for i, (start, length) in enumerate(zip(starts, lengths)):
        rows[i, :length] = flat[start : start + length]
    return rows


def whole(scaled: np.ndarray, limit: int) -> np.ndarray:
    """The floor of each entry as a long; raises where one is beyond ``limit``."""
    down = np.floor(scaled)
    if down.size and np.abs(down).max() > limit:
        raise ValueError(f"a scaled vector entry is beyond {limit}")
    return down.astype(np.int64)

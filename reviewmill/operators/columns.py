"""Projections: names, source file, struct lifting, declared types."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.functions.names import snake_name


def get_formatted_column_names(dataframe: DataFrame) -> DataFrame:
    """Rename every column to snake case in one projection; raise if two names meet."""
    names = [snake_name(name) for name in dataframe.columns]
    repeated = sorted(name for name, times in Counter(names).items() if times > 1)
    if repeated:
        raise ValueError(f"columns share a name after formatting: {', '.join(repeated)}")
    return dataframe.toDF(*names)


def add_file_source_column(dataframe: DataFrame, column_name: str = "file_source") -> DataFrame:
    """Add the input file of each row; empty text where the rows are not read from files."""
    return dataframe.withColumn(column_name, F.input_file_name())


def lift_struct(dataframe: DataFrame, struct: str, drop: Iterable[str] = ()) -> DataFrame:
    """Put every field of a struct at top level and drop the struct and other helpers."""
    helpers = {struct, *drop}
    kept = [F.col(f"`{name}`") for name in dataframe.columns if name not in helpers]
    return dataframe.select(*kept, f"{struct}.*")


def typed_null(name: str, kind: str = "string"):
    return F.lit(None).cast(kind).alias(name)


def conform(dataframe: DataFrame, schema: StructType, optional: Iterable[str] = ()) -> DataFrame:
    """Columns, order and types of a declared schema; bad values are null.

    A column that is absent raises, unless it is named as optional: then it is null.
    """
    present = set(dataframe.columns)
    absent = [name for name in schema.names if name not in present.union(optional)]
    if absent:
        raise ValueError(f"the feed has no column {', '.join(absent)}")
    return dataframe.select(
        *(
            F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
            if f.name in present
            else typed_null(f.name, f.dataType.simpleString())
            for f in schema.fields
        )
    )

"""Table schemas that grow: new columns, and types that widen.

Types form a lattice. Integers widen to longer ones, to decimals and doubles; booleans, numbers and dates to text; lists and
structs entry by entry, or to their JSON text where the other side is plain. Binary, maps and times
widen to nothing else. The schema of a table is stored with it, one file a version, so reading needs no
look into the files, and a later write is compared with what is there before anything is written.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    CharType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

from reviewmill.sources.storage import Store

INTEGERS = (ByteType, ShortType, IntegerType, LongType)
# Digits that hold every value of an integer type.
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
PLAIN = (*INTEGERS, BooleanType, DateType, DecimalType, DoubleType, FloatType, StringType)
MOST_DIGITS = 38
#: Largest whole number up to which doubles hold every one.
EXACT_DOUBLE = 2**53


class SchemaConflict(ValueError):
    """Two types that no type of the lattice holds both."""


def _decimal(kind: DataType) -> DecimalType:
    return kind if isinstance(kind, DecimalType) else DecimalType(DIGITS[type(kind)], 0)


def _number(a: DataType, b: DataType) -> DataType | None:
    whole_a, whole_b = isinstance(a, INTEGERS), isinstance(b, INTEGERS)
    if whole_a and whole_b:
        return max(a, b, key=lambda kind: INTEGERS.index(type(kind)))
    if isinstance(a, (*INTEGERS, DecimalType)) and isinstance(b, (*INTEGERS, DecimalType)):
        a, b = _decimal(a), _decimal(b)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= MOST_DIGITS else DoubleType()
    numbers = (*INTEGERS, DecimalType, FloatType, DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return DoubleType()
    return None


def merge_types(a: DataType, b: DataType, name: str = "value") -> DataType:
    """The least type that holds the values of both; associative, and the same from either side."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, (CharType, VarcharType)) or isinstance(b, (CharType, VarcharType)):
        a, b = (StringType() if isinstance(x, (CharType, VarcharType)) else x for x in (a, b))
        return merge_types(a, b, name)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merge_types(a.elementType, b.elementType, f"{name}[]"), a.containsNull or b.containsNull)
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b, f"{name}.")
    if (number := _number(a, b)) is not None:
        return number
    texts = (*PLAIN, ArrayType, StructType)
    if isinstance(a, texts) and isinstance(b, texts) and not _holds(a, BinaryType) and not _holds(b, BinaryType):
        return StringType()
    raise SchemaConflict(f"{name} is {a.simpleString()} and {b.simpleString()}")


def _holds(kind: DataType, wanted: type) -> bool:
    if isinstance(kind, ArrayType):
        return _holds(kind.elementType, wanted)
    if isinstance(kind, StructType):
        return any(_holds(f.dataType, wanted) for f in kind.fields)
    return isinstance(kind, wanted)


def merge_schemas(a: StructType, b: StructType, prefix: str = "") -> StructType:
    """Fields of ``a``, widened where ``b`` has them too whatever their case, then those that only ``b`` has."""
    others = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = others.pop(f.name.lower(), None)
        kind = f.dataType if other is None else merge_types(f.dataType, other.dataType, prefix + f.name)
        fields.append(StructField(f.name, kind, True))
    fields += [StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() in others]
    return StructType(fields)


def nullable(kind: DataType) -> DataType:
    """The type with nulls allowed everywhere, as files are read."""
    if isinstance(kind, ArrayType):
        return ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    return kind


def widened(column: Column, old: DataType, new: DataType, name: str = "value") -> Column:
    """Values of the old type as the new one; a number that a double would change raises."""
    old, new = nullable(old), nullable(new)
    if old == new:
        return column
    if isinstance(new, StringType) and isinstance(old, (ArrayType, StructType)):
        return F.to_json(column)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return F.transform(column, lambda entry: widened(entry, old.elementType, new.elementType, f"{name}[]"))
    if isinstance(old, StructType) and isinstance(new, StructType):
        had = {f.name.lower(): f for f in old.fields}
        made = []
        for f in new.fields:
            own = had.get(f.name.lower())
            value = F.lit(None).cast(f.dataType)
            if own is not None:
                value = widened(column.getField(own.name), own.dataType, f.dataType, f"{name}.{f.name}")
            made.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*made))
    if isinstance(new, DoubleType) and isinstance(old, (LongType, DecimalType)):
        far = (column > EXACT_DOUBLE) | (column < -EXACT_DOUBLE)
        message = F.concat(F.lit(f"{name} holds a number that a double would change: "), column.cast("string"))
        return F.when(far, F.raise_error(message).cast("double")).otherwise(column.cast("double"))
    return column.cast(new)


def as_schema(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows with the columns, order and types of a wider schema; columns that they lack are null."""
    had = {f.name.lower(): f for f in rows.schema.fields}
    columns = []
    for f in schema.fields:
        own = had.get(f.name.lower())
        value = F.lit(None).cast(f.dataType)
        if own is not None:
            value = widened(F.col(f"`{own.name}`"), own.dataType, f.dataType, f.name)
        columns.append(value.alias(f.name))
    return rows.select(*columns)


# --- The schema that is stored with a table -------------------------------------------------


def stored_schema(spark: SparkSession, table: str) -> StructType | None:
    """The last version stored with a table; a version whose write was cut off is passed over."""
    store, folder = Store(spark, table), f"{table.rstrip('/')}/_schema"
    for name in reversed(store.names(folder)):
        if not name.endswith(".json") or name.startswith("."):
            continue
        try:
            return StructType.fromJson(json.loads(store.read(f"{folder}/{name}")))
        except ValueError:
            continue
    return None


def store_schema(spark: SparkSession, table: str, schema: StructType) -> None:
    """Add a version if the schema differs from the last one."""
    if stored_schema(spark, table) == schema:
        return
    store, folder = Store(spark, table), f"{table.rstrip('/')}/_schema"
    versions = [int(name[:8]) for name in store.names(folder) if name[:8].isdigit()]
    store.create(f"{folder}/{max(versions, default=0) + 1:08d}.json", schema.json())


def table_schema(spark: SparkSession, table: str, by: str | None = None, by_type: DataType | None = None) -> StructType | None:
    """The stored schema, else the one of the files; None without files. Folder names tell no type, so ``by_type`` counts."""
    stored = stored_schema(spark, table)
    if stored is not None:
        return stored
    if not Store(spark, table).walk(table):
        return None
    found = spark.read.option("mergeSchema", "true").parquet(table).schema
    fields = [StructField(f.name, by_type if f.name == by and by_type else f.dataType, True) for f in found.fields]
    return nullable(StructType(fields))


def feed_schema(spark: SparkSession, inferred: StructType, table: str, rename) -> StructType:
    """The inferred fields of a feed, as wide as the table that they go to has them already."""
    stored = stored_schema(spark, table) or StructType()
    kinds = {f.name.lower(): f.dataType for f in stored.fields}
    return StructType(
        [
            StructField(f.name, merge_types(f.dataType, kinds.get(rename(f.name).lower(), NullType()), f.name), True)
            for f in inferred.fields
        ]
    )

"""One schema a table, types that widen, and loads that stop and go on."""

from __future__ import annotations

import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, MapType, NullType,
    StringType, StructField, StructType, TimestampType,
)

from reviewmill.plans import bronze
from reviewmill.sources import evolution, ledger, readers, writers
from reviewmill.sources.storage import Store

PLAIN = st.sampled_from(
    [NullType(), BooleanType(), IntegerType(), LongType(), DoubleType(), StringType(), DateType(), DecimalType(10, 2), DecimalType(30, 0)]
)
TYPES = st.recursive(
    PLAIN,
    lambda inner: st.one_of(
        inner.map(ArrayType),
        st.lists(inner, min_size=1, max_size=3).map(lambda ts: StructType([StructField("abc"[i], t) for i, t in enumerate(ts)])),
    ),
    max_leaves=5,
)


@settings(max_examples=300, deadline=None)
@given(TYPES, TYPES, TYPES)
def test_types_form_a_lattice(a, b, c):
    merge = evolution.merge_types
    assert merge(a, a) == a and merge(a, b) == merge(b, a)
    assert merge(a, merge(a, b)) == merge(a, b)
    assert merge(merge(a, b), c) == merge(a, merge(b, c))


@pytest.mark.parametrize(
    "a, b, merged",
    [
        ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("bigint", "string", "string"), ("boolean", "int", "string"),
        ("date", "string", "string"), ("decimal(5,2)", "int", "decimal(12,2)"), ("float", "double", "double"),
        ("array<int>", "array<string>", "array<string>"), ("array<int>", "string", "string"),
        ("struct<a:int>", "struct<a:double,b:string>", "struct<a:double,b:string>"), ("void", "struct<a:int>", "struct<a:int>"),
    ],
)
def test_merged_types(spark, a, b, merged):
    kind = StructType.fromDDL
    found = evolution.merge_schemas(kind(f"x {a}"), kind(f"X {b}"))
    assert found == evolution.nullable(kind(f"x {merged}"))


@pytest.mark.parametrize(
    "other", [BinaryType(), MapType(StringType(), LongType()), TimestampType(), ArrayType(BinaryType())], ids=lambda t: t.typeName()
)
def test_types_that_nothing_holds(other):
    with pytest.raises(evolution.SchemaConflict, match="vote is"):
        evolution.merge_types(StringType(), other, "vote")


def listing(path):
    return sorted(
        os.path.relpath(os.path.join(top, name), path)
        for top, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet") and "_staged" not in top
    )


def collected(spark, path, *columns):
    return sorted(map(tuple, readers.read_table(spark, path).select(*columns).collect()), key=str)


def test_votes_as_text_and_as_number_load_in_two_writes(spark, tmp_path, ansi):
    for name, vote in (("a", '"3"'), ("b", "3"), ("c", "null"), ("d", "1e2")):
        (tmp_path / "in" / name).mkdir(parents=True)
        line = f'{{"asin":"{name}","unixReviewTime":1577836800,"vote":{vote}}}\n'
        (tmp_path / "in" / name / "x.json").write_text(line)
    folders = readers.list_folders(spark, str(tmp_path / "in"))
    one, runs = str(tmp_path / "one"), str(tmp_path / "runs")
    assert bronze.load_bronze_reviews(spark, folders, one, per_write=1) == 4
    assert collected(spark, one, "asin", "vote") == [("a", "3"), ("b", "3"), ("c", None), ("d", "1e2")]
    assert spark.read.parquet(one).count() == 4
    # The number comes first, and the text with a later run.
    assert bronze.load_bronze_reviews(spark, [folders[1]], runs) == 1
    assert dict(readers.read_table(spark, runs).dtypes)["vote"] == "bigint"
    assert bronze.load_bronze_reviews(spark, folders, runs, per_write=1) == 3
    assert collected(spark, runs, "asin", "vote") == [("a", "3"), ("b", "3"), ("c", None), ("d", "1e2")]
    assert bronze.load_bronze_reviews(spark, folders, runs) == 0


def test_only_partitions_with_the_old_type_are_rewritten(spark, tmp_path, ansi):
    path = str(tmp_path / "t")
    ledger.grow_table(spark.createDataFrame([(1, "p")], "a int, k string"), path, "k")
    ledger.grow_table(spark.createDataFrame([(2, 7, "007")], "a int, n long, k string"), path, "k")
    before = listing(path)
    ledger.grow_table(spark.createDataFrame([(3, 0.5, "q"), (4, 1.5, "007")], "a int, n double, k string"), path, "k")
    after = listing(path)
    kept = [f for f in before if f in after]
    assert [f[:3] for f in kept] == ["k=p"] and len(after) == 4
    assert collected(spark, path, "a", "n", "k") == [(1, None, "p"), (2, 7.0, "007"), (3, 0.5, "q"), (4, 1.5, "007")]
    ledger.grow_table(spark.createDataFrame([(5, "many", "q")], "a int, N string, k string"), path, "k")
    assert collected(spark, path, "a", "n") == [(1, None), (2, "7.0"), (3, "0.5"), (4, "1.5"), (5, "many")]


def test_nested_fields_and_plain_tables_grow(spark, tmp_path, ansi):
    path = str(tmp_path / "t")
    ledger.grow_table(spark.createDataFrame([(1, [1], (2, None))], "i int, l array<int>, s struct<a:int,b:int>"), path)
    ledger.grow_table(spark.createDataFrame([(2, ["x"], ("y", 1.5))], "i int, l array<string>, s struct<a:string,c:double>"), path)
    rows = readers.read_table(spark, path).orderBy("i").collect()
    assert [(r.l, tuple(r.s)) for r in rows] == [(["1"], ("2", None, None)), (["x"], ("y", None, 1.5))]
    ledger.grow_table(spark.createDataFrame([(3, "plain")], "i int, s string"), path)
    texts = {r.i: r.s for r in readers.read_table(spark, path).collect()}
    assert json.loads(texts[1]) == {"a": "2"} and texts[3] == "plain"


def test_a_table_written_without_a_schema_grows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(spark.createDataFrame([(1, "2017")], "n long, year string"), path, "year")
    ledger.grow_table(spark.createDataFrame([("x", "2018")], "n string, year string"), path, "year")
    assert collected(spark, path, "n", "year") == [("1", "2017"), ("x", "2018")]


@pytest.mark.parametrize(
    "second, schema",
    [
        ((b"x",), "n binary"),  # no type holds both
        ((2**53 + 1,), "n long"),  # a double would change it
    ],
)
def test_an_impossible_change_raises_before_anything_is_written(spark, tmp_path, ansi, second, schema):
    path = str(tmp_path / "t")
    ledger.grow_table(spark.createDataFrame([(0.5,)], "n double"), path)
    before = listing(path)
    with pytest.raises(Exception, match="n is double and binary|n holds a number that a double would change"):
        ledger.grow_table(spark.createDataFrame([second], schema), path)
    assert listing(path) == before and collected(spark, path, "n") == [(0.5,)]
    ledger.grow_table(spark.createDataFrame([(2**53,)], "n long"), path)
    assert collected(spark, path, "n") == [(0.5,), (float(2**53),)]


def test_old_values_that_a_double_would_change_stay(spark, tmp_path, ansi):
    path = str(tmp_path / "t")
    ledger.grow_table(spark.createDataFrame([(-(2**63),)], "n long"), path)
    before = listing(path)
    with pytest.raises(Exception, match="a double would change"):
        ledger.grow_table(spark.createDataFrame([(0.5,)], "n double"), path)
    assert listing(path) == before and collected(spark, path, "n") == [(-(2**63),)]


def folders_of(tmp_path, n):
    for i in range(n):
        (tmp_path / "in" / f"f{i}").mkdir(parents=True)
        vote = i if i < 2 else f'"v{i}"'
        (tmp_path / "in" / f"f{i}" / "x.json").write_text(f'{{"asin":"{i}","unixReviewTime":{86400 * 40 * i},"vote":{vote}}}\n')
    return [str(tmp_path / "in" / f"f{i}") for i in range(n)]


@pytest.mark.parametrize("step", ["create", "move", "delete", "names"])
@pytest.mark.parametrize("nth", [0, 1, 3, 6])
def test_a_load_that_stops_anywhere_gives_each_row_once(spark, tmp_path, monkeypatch, step, nth):
    folders, table = folders_of(tmp_path, 4), str(tmp_path / "t")
    bronze.load_bronze_reviews(spark, folders[:2], table)  # votes are numbers so far
    calls, real = [], getattr(Store, step)

    def broken(self, *args):
        calls.append(args)
        if len(calls) == nth + 1:
            raise InterruptedError(step)
        return real(self, *args)

    monkeypatch.setattr(Store, step, broken)
    try:
        bronze.load_bronze_reviews(spark, folders, table, per_write=1)
    except InterruptedError:
        pass
    monkeypatch.undo()
    bronze.load_bronze_reviews(spark, folders, table, per_write=1)
    assert collected(spark, table, "asin", "vote") == [("0", "0"), ("1", "1"), ("2", "v2"), ("3", "v3")]
    assert ledger.Ledger(spark, table).recover() == 0


def test_a_batch_cut_off_while_it_is_opened_never_counts(spark, tmp_path):
    folders, table = folders_of(tmp_path, 2), str(tmp_path / "t")
    bronze.load_bronze_reviews(spark, folders[:1], table)
    Store(spark, table).create(f"{table}/_ledger/00000002.open.json", '{"folders": ["')
    assert bronze.load_bronze_reviews(spark, folders, table) == 1
    assert collected(spark, table, "asin") == [("0",), ("1",)]


def test_a_failed_read_leaves_the_table_and_the_ledger(spark, tmp_path):
    folders, table = folders_of(tmp_path, 3), str(tmp_path / "t")

    def read(session, paths):
        if paths[0].endswith("f1"):
            raise OSError("gone")
        return readers.read_json(session, paths)

    with pytest.raises(OSError):
        ledger.load_folders(spark, folders, read, table, per_write=1)
    assert ledger.Ledger(spark, table).pending(folders) == folders[1:]
    assert ledger.load_folders(spark, folders, readers.read_json, table, per_write=1) == 2
    assert ledger.load_folders(spark, folders + folders, readers.read_json, table) == 0
    assert collected(spark, table, "asin") == [("0",), ("1",), ("2",)]
    loaded = ledger.Ledger(spark, table).loaded()
    assert sorted((r.batch, r.folder[-2:]) for r in loaded.collect()) == [(1, "f0"), (2, "f1"), (3, "f2")]


def test_of_two_loads_that_open_one_batch_one_fails(spark, tmp_path, monkeypatch):
    table, rows = str(tmp_path / "t"), spark.createDataFrame([(1,)], "n int")
    ledger.grow_table(rows, table)
    monkeypatch.setattr(ledger.Ledger, "_batches", lambda self, suffix: [])
    Store(spark, table).create(f"{table}/_ledger/00000001.open.json", "{}")
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        ledger.grow_table(rows, table)
    assert spark.read.parquet(table).count() == 1

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.functions.names import snake_label, snake_name
from reviewmill.operators.columns import add_file_source_column, get_formatted_column_names

GOLDEN = [
    ("HelloWorld", "hello_world"),
    ("   Hello   World!  ", "hello_world"),
    ("   estación__format_", "estacion_format"),
    ("áéíóúÁÉÍÓÚâêîôÂÊÎÔãõÃÕçÇ", "aeiouaeiouaeioaeioaoaocc"),
    ("Some-Text_withMixeD-cAsE", "some_text_with_mixe_d_c_as_e"),
    # Three underscores leave two, and an unlisted letter becomes one.
    ("a___b", "a__b"),
    ("año", "a_o"),
]


@pytest.mark.parametrize("name,expected", GOLDEN)
def test_name_rule(name, expected):
    assert snake_name(name) == expected


def test_label_rule_is_the_name_rule(spark, ansi):
    rows = spark.createDataFrame(GOLDEN, "raw string, expected string")
    found = rows.select("expected", snake_label(F.col("raw")).alias("label")).collect()
    assert [r.label for r in found] == [r.expected for r in found]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("abYZ09 _-!.áÉñçÃ\t", max_size=12), min_size=40, max_size=60))
def test_label_and_name_agree_on_any_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "raw string")
    found = rows.select("raw", snake_label(F.col("raw")).alias("label")).collect()
    assert {r.raw: r.label for r in found} == {t: snake_name(t) for t in texts}


def test_columns_are_renamed(spark):
    frame = spark.createDataFrame([("Alice", "2020-01-01")], ["Name", "Registration Date"])
    assert get_formatted_column_names(frame).columns == ["name", "registration_date"]


def test_names_that_meet_are_refused(spark):
    frame = spark.createDataFrame([(1, 2)], ["Full Name", "fullName"])
    with pytest.raises(ValueError, match="full_name"):
        get_formatted_column_names(frame)


def test_file_source(spark, tmp_path):
    frame = spark.createDataFrame([("Alice",), ("Bob",)], ["Name"])
    assert {r.file_source for r in add_file_source_column(frame).collect()} == {""}
    frame.write.json(str(tmp_path / "in"))
    read = add_file_source_column(spark.read.json(str(tmp_path / "in")))
    assert all("/in/part-" in r.file_source for r in read.collect())

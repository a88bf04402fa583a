"""Every registered query against DuckDB, with ANSI mode on and off."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, ansi, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_queries_run_from_any_folder(tmp_path):
    """Tasks of a driver started elsewhere cannot import this repository's modules."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import queries
for name in ("enrich_scored", "historic_sentiment", "token_usage", "enrich_daily", "historic_backfill"):
    print(name, queries()[name](spark, {SF_DIR!r}).count())
print("DONE")
"""
    run = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "DONE" in run.stdout, run.stderr[-2000:]


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0

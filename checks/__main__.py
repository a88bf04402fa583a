"""``python -m checks [sf_dir] [name ...]``: all queries, or some, against DuckDB, with times."""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from checks import queries  # noqa: F401  registers the queries
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or sorted(QUERIES):
        start = time.monotonic()
        try:
            frame = QUERIES[name](spark, sf_dir)
            notes = differences(frame, connection, ORACLES[name])
        except Exception as problem:  # report it and go on with the next query
            notes = [str(problem)[:500]]
        failed += bool(notes)
        print(f"{name:26} {time.monotonic() - start:7.2f}s  {'; '.join(notes) or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time plans: join strategy by measured size, hot partitions split, small ones merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A hash join instead of sorting both sides, only where every build partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Shuffle files go with the query that made them, not when the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 128 * 1024**2, least: int = 200) -> int:
    """Partitions that keep each shuffle partition near the target; adaptive runs merge the surplus."""
    return max(least, -(-shuffled_bytes // target_bytes))


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Let this session's shuffles start with enough partitions for the size of the input tables."""
    size = 0
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size += files.getContentSummary(path).getLength()
    # Columnar input is a few times larger as rows.
    partitions = shuffle_partitions(4 * size)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    return partitions


@contextmanager
def settings_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries that are run inside."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(
    app_name: str = "reviewmill", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, or below the warehouse where that is not set.

    Both are shared by the driver and all executors. Paths of one session have one parent, so that
    ``clear_scratch`` removes them together once their frames are no longer needed.
    """
    return f"{_scratch_base(spark)}/{label}-{uuid.uuid4().hex}"


def _scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
        one_machine = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
        if scheme == "file" and not one_machine:
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share: {base} may be one machine's own")
    return f"{base.rstrip('/')}/reviewmill/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that this session has staged."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_base(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep(dataframe: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: worked out once, and safe from lost executors."""
    path = scratch_path(dataframe.sparkSession, label)
    dataframe.write.parquet(path)
    return dataframe.sparkSession.read.schema(dataframe.schema).parquet(path)

"""Batches that reach a table once, also when a load is stopped anywhere and started again.

A batch is written to a hidden staging folder of the table first. Then one file opens it in the table's
ledger: which folders it holds, which old files it replaces, and the schema it leaves. From there on the batch counts:
moving its files into place and deleting the old ones can be repeated, and the next load does so if this one
stops. A batch that was never opened has no effect but its staging folder. Of two loads that open the
same batch one fails. The files of a batch become visible one after the other, so readers wait for a load to end.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.sources.evolution import as_schema, merge_schemas, nullable, store_schema, table_schema
from reviewmill.sources.storage import Store
from reviewmill.sources.writers import FOLDERS_PER_WRITE, append_table

OPEN, DONE = ".open.json", ".json"


class Ledger:
    """The ledger of one table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self.store = Store(spark, self.table)
        self.folder = f"{self.table}/_ledger"

    def _batches(self, suffix: str) -> list[int]:
        names = self.store.names(self.folder)
        return [int(n[:8]) for n in names if n[:8].isdigit() and n[8:] == suffix]

    def recover(self) -> int:
        """Finish batches that were opened and not ended; returns their number."""
        open_ = sorted(set(self._batches(OPEN)) - set(self._batches(DONE)))
        for number in open_:
            try:
                entry = json.loads(self.store.read(f"{self.folder}/{number:08d}{OPEN}"))
            except ValueError:  # stopped while it was being opened: its files never counted
                self.store.delete([f"{self.folder}/{number:08d}{OPEN}"])
                continue
            self._finish(number, entry)
        return len(open_)

    def loaded(self) -> DataFrame:
        """One row (batch, folder) per folder that the table holds."""
        schema = "batch long, folders array<string>, staged string, remove array<string>, schema string"
        if not self._batches(DONE):
            return self.spark.createDataFrame([], "batch long, folder string")
        # The reader passes over hidden folders, so the files are named one by one.
        files = [f"{self.folder}/{n:08d}{DONE}" for n in self._batches(DONE)]
        entries = self.spark.read.schema(schema).json(files)
        return entries.select("batch", F.explode("folders").alias("folder"))

    def pending(self, folders: Sequence[str]) -> list[str]:
        """The folders that the table does not hold yet, in their order and each once."""
        if not folders:
            return []
        named = {self._name(folder): folder for folder in reversed(folders)}
        rows = self.spark.createDataFrame([(name,) for name in named], "folder string")
        missing = {r.folder for r in rows.join(self.loaded(), "folder", "left_anti").collect()}
        return [f for f in dict.fromkeys(folders) if self._name(f) in missing and named[self._name(f)] == f]

    def _name(self, folder: str) -> str:
        return Store(self.spark, folder).name

    def add(
        self,
        rows: DataFrame,
        folders: Sequence[str] = (),
        by: str | None = None,
        max_records: int | None = None,
        spread: bool = True,
    ) -> StructType:
        """Append rows as one batch and return the table's schema after it.

        Where a column's type has to widen, the partitions whose files hold the old type are rewritten in the
        same batch, file by file. A type that cannot hold both, or a value that it would change, raises before the table changes.
        ``spread`` is that of the table writers.
        """
        had = table_schema(self.spark, self.table, by, rows.schema[by].dataType if by else None)
        own = nullable(rows.schema)
        target = merge_schemas(had, own) if had is not None else own
        staged = f"{self.table}/_staged/{uuid.uuid4().hex}"
        if by and had is not None and had[by].dataType != target[by].dataType:
            raise ValueError(f"{by} names the partitions: its type cannot change")
        old = self._outdated(had, target, by) if had is not None else []
        if old:
            rows_there = self._files(old, had, by)
            append_table(as_schema(rows_there, target), staged, by, max_records, spread=False)
        append_table(as_schema(rows, target), staged, by, max_records, spread=spread)
        entry = {"folders": [self._name(f) for f in folders], "staged": staged, "remove": old, "schema": target.json()}
        number = max([0, *self._batches(DONE), *self._batches(OPEN)]) + 1
        entry["batch"] = number
        self.store.create(f"{self.folder}/{number:08d}{OPEN}", json.dumps(entry))
        self._finish(number, entry)
        return target

    def _outdated(self, had: StructType, target: StructType, by: str | None) -> list[str]:
        """Files, by their names in the table, of the partitions that hold a column in a narrower type."""
        changed = [f.name for f in had.fields if nullable(f.dataType) != nullable(target[f.name].dataType)]
        if not changed:
            return []
        files = self.store.walk(self.table)
        by_partition: dict[str, list[str]] = {}
        for name in files:
            by_partition.setdefault(name.rpartition("/")[0], []).append(name)
        concerned = []
        for names in by_partition.values():
            paths = [f"{self.table}/{n}" for n in names]
            there = {c.lower() for c in self.spark.read.option("mergeSchema", "true").parquet(*paths).columns}
            if there & {c.lower() for c in changed}:
                concerned += names
        return concerned

    def _files(self, names: list[str], schema: StructType, by: str | None) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", self.table)
        return reader.parquet(*(f"{self.table}/{n}" for n in names))

    def _finish(self, number: int, entry: dict) -> None:
        self.store.delete(f"{self.table}/{name}" for name in entry["remove"])
        for name in self.store.walk(entry["staged"]):
            self.store.move(f"{entry['staged']}/{name}", f"{self.table}/{name}")
        store_schema(self.spark, self.table, StructType.fromJson(json.loads(entry["schema"])))
        self.store.move(f"{self.folder}/{number:08d}{OPEN}", f"{self.folder}/{number:08d}{DONE}")
        self.store.delete([entry["staged"]])


def grow_table(rows: DataFrame, table: str, by: str | None = None, max_records: int | None = None) -> StructType:
    """Append rows to a table whose columns and types may grow; read it with ``readers.read_table``."""
    ledger = Ledger(rows.sparkSession, table)
    ledger.recover()
    return ledger.add(rows, (), by, max_records)


def load_folders(
    spark: SparkSession,
    folders: Sequence[str],
    read: Callable[[SparkSession, Sequence[str]], DataFrame],
    table: str,
    by: str | None = None,
    max_records: int | None = None,
    per_write: int | None = FOLDERS_PER_WRITE,
    progress: Callable[[int, int], None] | None = None,
) -> int:
    """Load the folders that the table does not hold yet, ``per_write`` at a time, or all in one write if it is None.

    Each write is one scan over its folders and one batch of the ledger, so a load that stops goes on where it
    was, and every folder is loaded once. Rows are written by the tasks that read them. A folder is known by its path: files that arrive in it later need a
    folder of their own. Returns the number of folders loaded by this call.
    """
    ledger = Ledger(spark, table)
    ledger.recover()
    pending = ledger.pending(folders)
    step = per_write or max(1, len(pending))
    for start in range(0, len(pending), step):
        batch = pending[start : start + step]
        ledger.add(read(spark, batch), batch, by, max_records, spread=False)
        if progress:
            progress(start + len(batch), len(pending))
    return len(pending)

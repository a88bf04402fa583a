"""An event source that needs no broker: a partitioned, append-only log in the shared store.

The log is a folder of segments, ``partition=<p>/<first offset>-<rows>-<first time>-<last time>.parquet``. A segment's name says which
offsets and enqueue times it holds, so offsets, ranges and start times are found without opening a file. Segments
appear whole, by a rename. ``EventLog`` reads the log as a stream or as a batch: one task a segment and range. The stream's
position is the next offset of each partition; it is kept in the query's checkpoint, so a restart goes on where it was, and a
batch that is run again reads the same ranges. After each batch the position can also be stored for a consumer group, from
which a new checkpoint may start. Tasks get the source by value and need not import this package.
"""

from __future__ import annotations

import bisect
import datetime as dt
import json
import re
import sys
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "body binary, offset string, sequenceNumber long, enqueuedTime timestamp, partition int"
SEGMENT = re.compile(r"(\d{20})-(\d+)-(-?\d+)-(-?\d+)\.parquet")
#: Events of a segment, and so of a task.
SEGMENT_ROWS = 1_000_000
MICROSECOND = dt.timedelta(microseconds=1)
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Segment(InputPartition):
    """A range of offsets in one file of the log."""

    def __init__(self, partition: int, path: str, first: int, rows: int, earliest: int, latest: int):
        super().__init__(path)
        self.partition, self.path, self.first, self.rows = partition, path, first, rows
        self.earliest, self.latest = earliest, latest
        self.start, self.end = first, first + rows

    def within(self, start: int, end: int) -> Segment | None:
        """The part of it in a range; None if there is none."""
        part = Segment(self.partition, self.path, self.first, self.rows, self.earliest, self.latest)
        part.start, part.end = max(self.start, start), min(self.end, end)
        return part if part.start < part.end else None


class Log:
    """The segments of a log, by their names."""

    def __init__(self, root: str):
        self.files, self.root = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
        self.root = self.root.rstrip("/")

    def segments(self) -> dict[int, list[Segment]]:
        found: dict[int, list[Segment]] = {}
        for info in self.files.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True)):
            folder, _, name = info.path.rpartition("/")
            if (match := SEGMENT.fullmatch(name)) and (kept := re.fullmatch(r"partition=(\d+)", folder.rpartition("/")[2])):
                first, rows, earliest, latest = map(int, match.groups())
                found.setdefault(int(kept[1]), []).append(Segment(int(kept[1]), info.path, first, rows, earliest, latest))
        return {p: sorted(found[p], key=lambda s: s.first) for p in sorted(found)}

    def ends(self) -> dict[str, int]:
        return {str(p): own[-1].end for p, own in self.segments().items()}

    def since(self, micros: int) -> dict[str, int]:
        """The first offset of each partition's first segment that reaches the time; its end if none does."""
        starts = {}
        for p, own in self.segments().items():
            reached, most = [], None
            for segment in own:
                most = segment.latest if most is None else max(most, segment.latest)
                reached.append(most)
            at = bisect.bisect_left(reached, micros)
            starts[str(p)] = own[at].first if at < len(own) else own[-1].end
        return starts

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        parts = []
        for p, own in self.segments().items():
            first, last = start.get(str(p), 0), end.get(str(p), 0)
            if first > last:
                raise ValueError(f"partition {p} of the log ends before the position {first}")
            parts += [part for segment in own if (part := segment.within(first, last))]
        return parts

    def position(self, group: str) -> dict[str, int] | None:
        path = f"{self.root}/_groups/{group}.json"
        if self.files.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(path) as stream:
            return json.loads(stream.read())

    def store(self, group: str, position: dict[str, int]) -> None:
        self.files.create_dir(f"{self.root}/_groups")
        path = f"{self.root}/_groups/{group}.json"
        with self.files.open_output_stream(f"{path}.new") as stream:
            stream.write(json.dumps(position).encode())
        self.files.move(f"{path}.new", path)

    def read(self, part: Segment, step: int = 10_000) -> Iterator[pa.RecordBatch]:
        """The events of a segment's range, in order."""
        with self.files.open_input_file(part.path) as file:
            at = part.first
            for batch in pq.ParquetFile(file).iter_batches(step, columns=["body", "sequenceNumber", "enqueuedTime"]):
                low, high = max(part.start - at, 0), min(part.end - at, batch.num_rows)
                if low < high:
                    piece = batch.slice(low, high - low)
                    offsets = [str(n) for n in range(at + low, at + high)]
                    # Files hold instants; whichever way they were written, they are microseconds in UTC here.
                    moments = piece.column("enqueuedTime").cast(pa.timestamp("us")).cast(pa.timestamp("us", tz="UTC"))
                    partition = pa.array([part.partition] * len(offsets), pa.int32())
                    columns = [piece.column("body"), pa.array(offsets), piece.column("sequenceNumber"), moments, partition]
                    yield pa.RecordBatch.from_arrays(columns, names=["body", "offset", "sequenceNumber", "enqueuedTime", "partition"])
                at += batch.num_rows


def _start(log: Log, options) -> dict[str, int]:
    """The start that the options name: offsets, a time, a consumer group, ``latest``, or else the beginning."""
    if options.get("startingOffsets"):
        return json.loads(options["startingOffsets"])
    place = options.get("startingPosition", "earliest")
    if place == "earliest":
        return {}
    if place == "latest":
        return log.ends()
    if place == "group":
        return log.position(options["group"]) or {}
    moment = dt.datetime.fromisoformat(place)
    moment = moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment
    return log.since((moment - EPOCH) // MICROSECOND)


class EventLog(DataSource):
    """``spark.readStream.format("event_log").option("path", ...)`` after ``spark.dataSource.register(EventLog)``.

    Options: ``path``; ``startingOffsets`` (JSON of offsets by partition) or ``startingPosition`` (``earliest``, ``latest``,
    ``group`` or a UTC time: whole segments before it are not opened); ``group``, whose position each commit stores.
    """

    @classmethod
    def name(cls) -> str:
        return "event_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self.options)


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self) -> list[Segment]:
        log = Log(self.options["path"])
        return log.ranges(_start(log, self.options), log.ends()) or [Segment(-1, "", 0, 0, 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from Log(self.options["path"]).read(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.options = options

    def initialOffset(self) -> dict:
        return _start(Log(self.options["path"]), self.options)

    def latestOffset(self) -> dict:
        return Log(self.options["path"]).ends()

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return Log(self.options["path"]).ranges(start, end)

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        yield from Log(self.options["path"]).read(partition)

    def commit(self, end: dict) -> None:
        if self.options.get("group"):
            Log(self.options["path"]).store(self.options["group"], end)


def read_log(spark: SparkSession, root: str, stream: bool = True, **options: str) -> DataFrame:
    """The log as a stream of event envelopes, or as a batch."""
    spark.dataSource.register(EventLog)
    reader = (spark.readStream if stream else spark.read).format("event_log").option("path", root)
    return reader.options(**options).load()


def append_events(events: DataFrame, root: str, partitions: int = 4, segment_rows: int = SEGMENT_ROWS) -> int:
    """Append envelopes to the log, dealt over its partitions by sequence number, and return their number.

    Offsets go on from each partition's last one, in order of enqueue time. Segments are staged and measured, then renamed
    into place; an append that stops before that leaves the log as it was. One producer appends at a time.
    """
    from reviewmill.sources.storage import Store

    spark = events.sparkSession
    ends = Log(root).ends()
    moment = F.col("enqueuedTime")
    if events.schema["enqueuedTime"].dataType.simpleString() == "timestamp_ntz":
        moment = F.to_timestamp(F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z")))
    rows = events.select(F.col("body").cast("binary").alias("body"), "sequenceNumber", moment.alias("enqueuedTime"))
    rows = rows.withColumn("partition", F.pmod(F.xxhash64("sequenceNumber"), F.lit(partitions)).cast("int"))
    base = F.lit(0).cast("long")
    for partition, end in ends.items():
        base = F.when(F.col("partition") == int(partition), F.lit(end).cast("long")).otherwise(base)
    order = Window.partitionBy("partition").orderBy("enqueuedTime", "sequenceNumber", F.xxhash64("body"))
    numbered = rows.withColumn("offset", base + F.row_number().over(order) - 1)
    staged = f"{root.rstrip('/')}/_incoming/{uuid.uuid4().hex}"
    ordered = numbered.repartition("partition").sortWithinPartitions("partition", "offset")
    ordered.write.option("maxRecordsPerFile", segment_rows).partitionBy("partition").parquet(staged)
    found = spark.read.schema(numbered.schema).parquet(staged)
    times = F.unix_micros("enqueuedTime")
    measured = found.groupBy("partition", F.col("_metadata.file_path").alias("file")).agg(
        F.min("offset").alias("first"), F.count("*").alias("rows"), F.min(times).alias("earliest"), F.max(times).alias("latest")
    )
    store, total = Store(spark, root), 0
    for s in sorted(measured.collect(), key=lambda s: (s.partition, s.first)):
        name = f"{s.first:020d}-{s.rows}-{s.earliest}-{s.latest}.parquet"
        store.move(unquote(s.file), f"{root.rstrip('/')}/partition={s.partition}/{name}")
        total += s.rows
    store.delete([staged])
    return total

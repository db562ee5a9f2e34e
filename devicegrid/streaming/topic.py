"""A topic landed as segments, read by offsets: a streaming source without a broker.

A landed topic is a folder of Parquet files, ``partition=P/segment=S/``; segment
S holds the offsets S * size to (S + 1) * size - 1 of its partition, in which
offsets rise but may leave gaps shorter than a segment.  Spark writes the
segments (``land``) and its tasks read them, each a range of offsets; the
driver sees folder names and the footers of each partition's newest segment.

* ``starting``: ``earliest`` (oldest segment still there) or ``latest`` (what is
  landed after the query's first start).  A partition that appears later is
  read from its oldest segment.
* Admission: a micro-batch takes ``max_offsets`` offsets at most, shared among
  the partitions in proportion to what each has waiting.
* A missing segment inside the range to read is lost data: an error with
  ``fail_on_data_loss``, else it is passed over.
* Progress is kept twice: by Spark in the query's checkpoint, which alone
  decides what is read, and as planned ends in the folder ``progress``, so that
  a restarted source never plans behind them.  A stop between the two makes the
  next batch larger, by one batch's share at most; nothing is lost or repeated.

A bounded run is ``drain``: Spark ends a query on such a source after one
batch under an available-now trigger.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

SEGMENT_OFFSETS = 10_000
MAX_OFFSETS = 200_000
TASK_OFFSETS = 50_000
ENVELOPE_DDL = "key string, value string, kafka_ts timestamp, partition int, offset long"
ARROW = pa.schema([("key", pa.string()), ("value", pa.string()), ("kafka_ts", pa.timestamp("us", tz="UTC")),
                   ("partition", pa.int32()), ("offset", pa.int64())])


def land(messages: DataFrame, path: str, segment_offsets: int = SEGMENT_OFFSETS) -> None:
    """Append messages (envelope columns) to a landed topic, a file a segment.

    A task costs its files, not its bytes, so small ones are not put together.
    """
    tasks = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (messages.select("key", "value", "kafka_ts", "partition", "offset")
     .withColumn("segment", F.floor(F.col("offset") / F.lit(segment_offsets)).cast("long"))
     .repartition(tasks, "partition", "segment").sortWithinPartitions("partition", "segment", "offset")
     .write.mode("append").partitionBy("partition", "segment").parquet(path))


def topic_stream(spark: SparkSession, path: str, progress: str, starting: str = "earliest",
                 max_offsets: int = MAX_OFFSETS, fail_on_data_loss: bool = False,
                 segment_offsets: int = SEGMENT_OFFSETS, task_offsets: int = TASK_OFFSETS) -> DataFrame:
    """A landed topic as a streaming frame with the envelope columns."""
    if starting not in ("earliest", "latest"):
        raise ValueError(f"starting is 'earliest' or 'latest', not {starting!r}")
    spark.dataSource.register(LandedTopic)
    return (spark.readStream.format(LandedTopic.name())
            .option("progress", progress).option("starting", starting)
            .option("max_offsets", max_offsets).option("task_offsets", task_offsets)
            .option("segment_offsets", segment_offsets)
            .option("fail_on_data_loss", str(fail_on_data_loss).lower())
            .load(path))


def drain(query: StreamingQuery) -> None:
    """Read batch after batch until nothing waits, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def admitted(done: dict[str, int], ends: dict[str, int], limit: int) -> dict[str, int]:
    """Ends of the next batch: at most ``limit`` offsets beyond ``done`` in all,
    shared in proportion to what waits, largest remainders first."""
    waiting = {p: max(0, e - done.get(p, e)) for p, e in ends.items()}
    total = sum(waiting.values())
    if total <= limit:
        share = waiting
    else:
        share = {p: w * limit // total for p, w in waiting.items()}
        left = limit - sum(share.values())
        for p in sorted(waiting, key=lambda p: (-(waiting[p] * limit % total), p))[:left]:
            share[p] += 1
    return {p: done[p] + share.get(p, 0) for p in done}


@dataclass
class OffsetRange(InputPartition):
    """Offsets ``first`` to ``past`` - 1 of a partition, in these files."""

    partition: int
    first: int
    past: int
    files: list[str]


class LandedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_topic"

    def schema(self) -> str:
        return ENVELOPE_DDL

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(dict(self.options))


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.progress = options["path"], options["progress"]
        self.starting = options["starting"]
        self.limit, self.per_task = int(options["max_offsets"]), int(options["task_offsets"])
        self.size = int(options["segment_offsets"])
        self.strict = options["fail_on_data_loss"] == "true"
        self.start: dict[str, int] | None = None
        self.planned: dict[str, int] | None = None
        #: Segments and ends as last listed: a listing costs what is landed, not what a batch reads.
        self.listed: dict[str, dict[int, str]] = {}
        self.ends: dict[str, int] = {}

    # What is landed

    def _folder(self, path: str) -> tuple[fs.FileSystem, str]:
        if path.startswith("file:"):
            path = "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)

    def _named(self, path: str, column: str) -> dict[int, str]:
        """Sub-folders ``column=number`` of a folder, by number."""
        files, root = self._folder(path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return {int(f.base_name.split("=")[1]): f"{path}/{f.base_name}" for f in found
                if f.type == fs.FileType.Directory and f.base_name.startswith(f"{column}=")}

    def _parts(self, path: str) -> list[str]:
        files, root = self._folder(path)
        return sorted(f.path for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True))
                      if f.type == fs.FileType.File and f.base_name.endswith(".parquet"))

    def _segments(self) -> dict[str, dict[int, str]]:
        found = {str(p): self._named(folder, "segment") for p, folder in self._named(self.path, "partition").items()}
        return {p: segments for p, segments in found.items() if segments}

    def _look(self) -> None:
        self.listed = self._segments()
        self.ends = {p: self._end(s) for p, s in self.listed.items()}

    def _held(self, partition: str, first: int, past: int) -> dict[int, str]:
        """Segments of a range of offsets; those not yet seen are looked for once more."""
        span = range(first // self.size, (past - 1) // self.size + 1)
        known = self.listed.get(partition, {})
        if len(span) > len(known) or not all(s in known for s in span):
            known = self.listed[partition] = self._named(f"{self.path}/partition={partition}", "segment")
        return {s: known[s] for s in span if s in known} if len(span) <= len(known) else {s: known[s] for s in sorted(known) if s in span}

    def _end(self, segments: dict[int, str]) -> int:
        """One past the newest offset of a partition, from its newest segment's footers."""
        newest = max(segments)
        files, _ = self._folder(self.path)
        past = newest * self.size
        for path in self._parts(segments[newest]):
            meta = pq.read_metadata(path, filesystem=files)
            at = meta.schema.names.index("offset")
            groups = (meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups))
            past = max([past, *(s.max + 1 for s in groups if s is not None and s.has_min_max)])
        return past

    # Progress of this source

    def _saved(self, what: str) -> dict[str, int] | None:
        """The newest whole record; one cut off while it was written does not count."""
        files, root = self._folder(f"{self.progress}/{what}")
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        for f in sorted((f.path for f in found if f.type == fs.FileType.File), reverse=True):
            with files.open_input_stream(f) as stream:
                try:
                    return json.loads(stream.read())
                except json.JSONDecodeError:
                    continue
        return None

    def _save(self, what: str, offsets: dict[str, int]) -> None:
        files, root = self._folder(f"{self.progress}/{what}")
        files.create_dir(root, recursive=True)
        with files.open_output_stream(f"{root}/{sum(offsets.values()):020d}.json") as stream:
            stream.write(json.dumps(offsets, sort_keys=True).encode())

    # Spark's calls on the driver

    def initialOffset(self) -> dict[str, int]:
        if self.start is None:
            self.start = self._saved("start")
        if self.start is None:
            latest = self.starting == "latest"
            self.start = {p: self._end(s) if latest else min(s) * self.size for p, s in self._segments().items()}
            self._save("start", self.start)
        return self.start

    def latestOffset(self) -> dict[str, int]:
        if self.planned is None:
            self.planned = self._saved("planned") or self.initialOffset()
        # Listed anew only when less than a batch is known to wait.
        if sum(max(0, e - self.planned.get(p, e)) for p, e in self.ends.items()) < self.limit:
            self._look()
        done = {p: min(s) * self.size for p, s in self.listed.items()} | self.planned
        ends = admitted(done, self.ends, self.limit)
        if ends != self.planned:
            self._save("planned", ends)
            self.planned = ends
        return ends

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[OffsetRange]:
        out = []
        for p, past in end.items():
            if p not in start and p not in self.listed:
                self._look()
            first = start.get(p, min(self.listed.get(p, {}), default=0) * self.size)
            if past <= first:
                continue
            held = {s: self._parts(folder) for s, folder in self._held(p, first, past).items()}
            wanted = [s for s, files in held.items() if files]  # a listed segment may be gone
            lost = (past - 1) // self.size - first // self.size + 1 - len(wanted)
            if lost and self.strict:
                raise RuntimeError(f"{lost} segments of partition {p} are missing between the offsets {first} and {past}")
            step = max(1, self.per_task // self.size)
            for i in range(0, len(wanted), step):
                some = wanted[i:i + step]
                out.append(OffsetRange(int(p), max(first, some[0] * self.size), min(past, (some[-1] + 1) * self.size),
                                       [f for s in some for f in held[s]]))
        return out

    def commit(self, end: dict[str, int]) -> None:
        """Older records of planned ends are not needed any more."""
        files, root = self._folder(f"{self.progress}/planned")
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        for f in found:
            if f.base_name < f"{sum(end.values()):020d}.json":
                files.delete_file(f.path)

    # In the tasks

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        files, _ = self._folder(self.path)
        for path in partition.files:
            try:
                with files.open_input_file(path) as f:
                    rows = pq.ParquetFile(f).read(["key", "value", "kafka_ts", "offset"])
            except FileNotFoundError:
                if self.strict:
                    raise
                continue
            rows = rows.filter((pc.field("offset") >= partition.first) & (pc.field("offset") < partition.past))
            rows = rows.append_column("partition", pa.array([partition.partition] * len(rows), pa.int32()))
            yield from rows.select(ARROW.names).cast(ARROW).to_batches()

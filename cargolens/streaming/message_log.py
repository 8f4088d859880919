"""Topic source and ordered publish over partitioned message files (SRC6, SNK5,
STR2, STR4), as Python data sources.

A topic is a folder with one sub-folder per partition. A partition's messages
lie in segment files, ``<first offset>-<end offset>.parquet``, in the order of
their offsets (key, value and time; segments of an earlier version are
``.jsonl``, one message a line, and stay readable); the offsets of a partition
run through from 0. The format is the one thing both sides agree on:

* ``message_log`` as a stream or batch source gives (key, value, topic,
  partition, offset, timestamp), as a broker's source does. A task reads at
  most ``SPAN`` messages. The stream's position is the offset per partition,
  kept in the query's checkpoint; it may lie in the middle of a segment.
  ``maxOffsetsPerTrigger`` bounds a batch; as Spark asks a Python source for the
  latest offset without saying where the query stands, the planned position is
  also kept in the file ``position`` (put it into the checkpoint folder).
* ``message_log`` as a sink appends (key, value). ``publish_batch`` deals the
  rows by ranges of partition and sequence, sorted by Spark: many tasks write a
  partition, and the commit puts their parts in order. ``publish_stream`` deals
  every micro-batch by key, so a partition has one writer and an epoch that is
  replayed gives the same parts. The order per key is that of the given column.

A writer stages its part under ``_pending``; the commit of the epoch, on the
driver, gives the parts their offsets and renames them in place, and then
writes ``_epochs/<query>-<epoch>``. An epoch that is replayed after its commit
is recognised by that mark and dropped; one that failed before it leaves parts
that no reader sees.

Paths are opened through pyarrow, so any store it knows will do; on a cluster
the folder must be one that all executors share.
"""

from __future__ import annotations

import base64
import json
import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

from cargolens.sinks.small_files import open_store

FORMAT = "message_log"
SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
SEGMENT = re.compile(r"(\d+)-(\d+)\.(?:jsonl|parquet)$")
#: Messages that a task reads at most.
SPAN = 1_000_000
#: Bytes of messages that a writer holds before it writes them.
HELD_BYTES = 16 << 20

_store = open_store


class Log:
    """The segments of a topic folder."""

    def __init__(self, path: str):
        self.fs, self.root = _store(path)

    def _list(self, folder: str, recursive: bool = False):
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))

    def partitions(self) -> list[int]:
        return sorted(int(i.base_name.split("=")[1]) for i in self._list(self.root) if i.base_name.startswith("partition="))

    def segments(self, partition: int) -> list[tuple[int, int, str]]:
        """(first offset, end offset, path), ascending."""
        found = [(SEGMENT.search(i.base_name), i.path) for i in self._list(f"{self.root}/partition={partition}")]
        return sorted((int(m[1]), int(m[2]), path) for m, path in found if m)

    def ends(self) -> dict[str, int]:
        """The offset that the next message of each partition will get."""
        return {str(p): max((end for _, end, _ in self.segments(p)), default=0) for p in self.partitions()}

    def read(self, partition: int, start: int, end: int):
        """(first offset, Arrow batch of key, value and time) of the messages in [start, end)."""
        for first, last, path in self.segments(partition):
            if last <= start or first >= end:
                continue
            chunks = self._lines(path) if path.endswith(".jsonl") else self._groups(path, start - first, end - first)
            for at, batch in chunks:
                at += first
                skip, stop = max(0, start - at), min(batch.num_rows, end - at)
                if skip < stop:
                    yield at + skip, batch.slice(skip, stop - skip)

    def _groups(self, path: str, start: int, end: int):
        """(place, batch) of the row groups that meet [start, end)."""
        import pyarrow.parquet as pq

        with self.fs.open_input_file(path) as f:
            table, at = pq.ParquetFile(f), 0
            for i in range(table.num_row_groups):
                n = table.metadata.row_group(i).num_rows
                if at < end and at + n > start:
                    place = at
                    for batch in table.iter_batches(row_groups=[i]):
                        yield place, batch
                        place += batch.num_rows
                at += n

    def _lines(self, path: str, chunk: int = 10_000):
        import io
        import itertools

        import pyarrow as pa

        with self.fs.open_input_stream(path) as stream:
            lines, at = io.TextIOWrapper(stream, "utf-8"), 0
            while rows := [json.loads(line) for line in itertools.islice(lines, chunk)]:
                columns = [[_bytes(m["k"]) for m in rows], [_bytes(m["v"]) for m in rows], [m["t"] for m in rows]]
                yield at, pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _types(), strict=True)], list("kvt"))
                at += len(rows)

    def stage(self, name: str):
        """An open file that no reader sees, and its path."""
        self.fs.create_dir(f"{self.root}/_pending", recursive=True)
        path = f"{self.root}/_pending/{name}"
        return self.fs.open_output_stream(path), path

    def committed(self, epoch: str) -> bool:
        from pyarrow import fs

        return self.fs.get_file_info(f"{self.root}/_epochs/{epoch}").type != fs.FileType.NotFound

    def commit(self, epoch: str, parts: list[Part]) -> None:
        """Give the parts their offsets, once per epoch.

        The places are written down before the first rename, so a commit that
        was interrupted is finished with the same offsets."""
        if self.committed(epoch):
            self.drop(parts)
            return
        plan_path = f"{self.root}/_epochs/_plan-{epoch}"
        self.fs.create_dir(f"{self.root}/_epochs", recursive=True)
        from pyarrow import fs

        if self.fs.get_file_info(plan_path).type != fs.FileType.NotFound:
            with self.fs.open_input_stream(plan_path) as f:
                places = {int(p): at for p, at in json.loads(f.read()).items()}
        else:
            ends = self.ends()
            places = {p.partition: ends.get(str(p.partition), 0) for p in parts}  # of the first part
            with self.fs.open_output_stream(plan_path) as f:
                f.write(json.dumps(places).encode())
        for part in parts:
            folder = f"{self.root}/partition={part.partition}"
            self.fs.create_dir(folder, recursive=True)
            at = places[part.partition]
            places[part.partition] = at + part.messages
            target = f"{folder}/{at:020d}-{at + part.messages:020d}.parquet"
            if self.fs.get_file_info(target).type == fs.FileType.NotFound:
                self.fs.move(part.path, target)
            else:  # the interrupted commit came this far
                self.drop([part])
        with self.fs.open_output_stream(f"{self.root}/_epochs/{epoch}") as f:
            f.write(b"")
        self.fs.delete_file(plan_path)

    def drop(self, parts: list[Part]) -> None:
        from pyarrow import fs

        for part in parts:
            if self.fs.get_file_info(part.path).type != fs.FileType.NotFound:
                self.fs.delete_file(part.path)


def _bytes(text: str | None) -> bytes | None:
    return None if text is None else base64.b64decode(text)


def _types():
    import pyarrow as pa

    return [pa.binary(), pa.binary(), pa.int64()]


@dataclass
class Span(InputPartition):
    """Messages [start, end) of a partition."""

    partition: int
    start: int
    end: int


@dataclass
class Part(WriterCommitMessage):
    """What a task staged for one partition."""

    partition: int
    messages: int
    path: str


def _spans(partition: int, start: int, end: int) -> list[Span]:
    return [Span(partition, at, min(at + SPAN, end)) for at in range(start, end, SPAN)]


class _Reads:
    def _rows(self, span: Span | None):
        import pyarrow as pa

        if span is None:  # a topic without messages has no partition to read
            return
        topic = self.path.rstrip("/").split("/")[-1]
        names = ["key", "value", "topic", "partition", "offset", "timestamp"]
        for first, batch in Log(self.path).read(span.partition, span.start, span.end):
            n = batch.num_rows
            time_of = pa.array(batch.column(2).cast(pa.timestamp("ms")).cast(pa.timestamp("us")), pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
            columns = [batch.column(0), batch.column(1), pa.repeat(topic, n), pa.repeat(pa.scalar(span.partition, pa.int32()), n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(range(first, first + n), pa.int64()), time_of], names)


class LogReader(_Reads, DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [s for p, end in Log(self.path).ends().items() for s in _spans(int(p), 0, end)]

    def read(self, partition):
        return self._rows(partition)


class LogStreamReader(_Reads, DataSourceStreamReader):
    """Offsets are {partition: next offset}; a partition that appears later starts at 0.

    A batch ends at most ``most`` messages after the last planned end. That end
    is written down when a batch is planned, so it is never behind the query:
    a batch that was planned before a restart is planned again first."""

    def __init__(self, path: str, most: int | None, position: str | None):
        if most and not position:
            raise ValueError("maxOffsetsPerTrigger needs a position file")
        self.path, self.most, self.position = path, most, position

    def planned(self) -> dict[str, int]:
        from pyarrow import fs

        store, path = _store(self.position)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return {}
        with store.open_input_stream(path) as f:
            return json.loads(f.read())

    def initialOffset(self):
        return {p: 0 for p in Log(self.path).ends()}

    def latestOffset(self):
        ends = Log(self.path).ends()
        if self.most:
            at, share = self.planned(), max(1, self.most // max(1, len(ends)))
            ends = {p: min(end, at.get(p, 0) + share) for p, end in ends.items()}
        return ends

    def partitions(self, start, end):
        if self.most:
            store, path = _store(self.position)
            with store.open_output_stream(f"{path}.new") as f:
                f.write(json.dumps(end).encode())
            store.move(f"{path}.new", path)
        return [s for p, n in sorted(end.items(), key=lambda x: int(x[0])) for s in _spans(int(p), start.get(p, 0), n)]

    def read(self, partition):
        return self._rows(partition)

    def commit(self, end):
        pass


class _Writes:
    """Tasks stage the rows (key, value, partition, sequence) of their
    partitions in the order they come."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator):
        import uuid

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        log, now = Log(self.path), int(time.time() * 1000)
        schema = pa.schema(list(zip("kvt", _types(), strict=True)))
        writers, held, counts, paths, streams = {}, {}, {}, {}, []

        def put(p):
            table = pa.Table.from_batches(held[p], schema)
            writers[p].write_table(table, row_group_size=max(1, table.num_rows))
            held[p] = []

        try:
            for batch in self.in_order(iterator):
                partitions = batch.column("partition")
                for p in pc.unique(partitions).to_pylist():
                    rows = batch.filter(pc.equal(partitions, p))
                    if p not in writers:
                        stream, paths[p] = log.stage(f"{p}-{uuid.uuid4().hex}")
                        streams.append(stream)
                        writers[p] = pq.ParquetWriter(stream, schema, compression="zstd", use_dictionary=False)
                        held[p], counts[p] = [], 0
                    columns = [rows.column(c).cast(pa.binary()) for c in ("key", "value")]
                    held[p].append(pa.RecordBatch.from_arrays([*columns, pa.repeat(pa.scalar(now, pa.int64()), rows.num_rows)], schema=schema))
                    counts[p] += rows.num_rows
                    if sum(b.nbytes for b in held[p]) >= HELD_BYTES:
                        put(p)
            for p in writers:
                if held[p]:
                    put(p)
        finally:
            for f in [*writers.values(), *streams]:
                f.close()
        return Parts([Part(p, n, paths[p]) for p, n in counts.items()])

    def in_order(self, batches):
        return batches  # sorted by Spark


@dataclass
class Parts(WriterCommitMessage):
    parts: list[Part]


def _parts(messages, ranged: bool, log: Log) -> list[Part]:
    """The parts of all tasks, a partition's in the order of the tasks."""
    found = [part for m in messages if m is not None for part in m.parts]
    if not ranged and len({p.partition for p in found}) < len(found):
        log.drop(found)
        raise ValueError("several tasks wrote one partition: deal the rows by partition first")
    return sorted(found, key=lambda p: p.partition)


class LogWriter(_Writes, DataSourceArrowWriter):
    def __init__(self, path: str, epoch: str | None = None, ranged: bool = False):
        import uuid

        super().__init__(path)
        self.epoch, self.ranged = epoch or f"batch-{uuid.uuid4().hex}", ranged

    def commit(self, messages):
        log = Log(self.path)
        log.commit(self.epoch, _parts(messages, self.ranged, log))

    def abort(self, messages):
        Log(self.path).drop([p for m in messages if m is not None for p in m.parts])


class LogStreamWriter(_Writes, DataSourceStreamArrowWriter):
    def __init__(self, path: str, query: str):
        super().__init__(path)
        self.query = query

    def in_order(self, batches):
        # Spark does not sort streams; a task holds its part of one micro-batch
        import pyarrow as pa
        import pyarrow.compute as pc

        found = list(batches)
        if not found:
            return []
        table = pa.Table.from_batches(found)
        order = pc.sort_indices(table, sort_keys=[("sequence", "ascending")], null_placement="at_start")
        return table.take(order).to_batches()

    def commit(self, messages, batchId):
        log = Log(self.path)
        log.commit(f"{self.query}-{batchId:012d}", _parts(messages, False, log))

    def abort(self, messages, batchId):
        Log(self.path).drop([p for m in messages if m is not None for p in m.parts])


class MessageLog(DataSource):
    """Options: path; maxOffsetsPerTrigger and position (stream source); query
    (stream sink); epoch, ranged (batch sink: the name of what is written, and
    whether the tasks hold ascending ranges of partition and sequence)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LogReader(self.options["path"])

    def streamReader(self, schema):
        most = self.options.get("maxOffsetsPerTrigger")
        return LogStreamReader(self.options["path"], int(most) if most else None, self.options.get("position"))

    def writer(self, schema, overwrite):
        return LogWriter(self.options["path"], self.options.get("epoch"), self.options.get("ranged") == "true")

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(self.options["path"], self.options["query"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)


def topic_stream(
    spark: SparkSession, path: str, max_offsets_per_trigger: int | None = None, checkpoint: str | None = None
) -> DataFrame:
    """A topic folder as a stream of (key, value, topic, partition, offset,
    timestamp). A bound on the batches needs the query's checkpoint folder."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("path", path)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).option("position", f"{checkpoint}/position.json")
    return reader.load()


def topic_table(spark: SparkSession, path: str) -> DataFrame:
    """All messages that the topic folder holds now."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()


def placed(messages: DataFrame, partitions: int, sequence: str) -> DataFrame:
    """(key, value, partition, sequence). A message's partition follows from its
    key alone; messages without a key are spread by their value."""
    by = F.xxhash64(F.coalesce("key", F.col("value")))
    return messages.select("key", "value", F.pmod(by, F.lit(partitions)).cast("int").alias("partition"), F.col(sequence).alias("sequence"))


def dealt(messages: DataFrame, partitions: int, sequence: str) -> DataFrame:
    """``placed`` with all rows of a partition in one task."""
    return placed(messages, partitions, sequence).repartition(partitions, "partition")


def publish_batch(messages: DataFrame, path: str, partitions: int, sequence: str) -> None:
    """Append (key, value) messages to a topic folder; ``sequence`` is the
    column whose order is kept per key."""
    register(messages.sparkSession)
    order = ["partition", "sequence"]
    rows = placed(messages, partitions, sequence).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.format(FORMAT).option("path", path).option("ranged", "true").mode("append").save()


def publish_stream(
    messages: DataFrame, path: str, checkpoint: str, query: str, partitions: int, sequence: str
) -> StreamingQuery:
    """Publish a stream of (key, value): every micro-batch is one epoch that is
    appended once, whatever is replayed. ``query`` names this publisher for
    good (one per checkpoint). Order holds inside a batch and from batch to
    batch."""
    from cargolens.streaming.jobs import _drain

    register(messages.sparkSession)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = dealt(batch, partitions, sequence).sortWithinPartitions("partition", "sequence")
        rows.write.format(FORMAT).option("path", path).option("epoch", f"{query}-{batch_id:012d}").mode("append").save()

    return _drain(messages, checkpoint, write_batch)


def drain(source: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Copy a topic stream into a table, in batches of the source's size, until
    nothing is left."""
    writer = source.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query

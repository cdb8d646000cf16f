"""The segment index of a log: which files hold which offsets and times, and a sink that commits files and index in one step.

A log folder has parquet files under ``topic=../partition=..`` and an index under ``_index``. A file is a segment: the rows of
one partition from a base offset on, without gaps. Every commit adds one index file with a row per new segment, and with what
the log is afterwards: the end of every partition, the last batch of every named writer. So the ends are read from one small
file however long the log is, and a replay opens only the files that hold what it asks for. Index files are merged by the
power of ``FANOUT`` they reach, so there are few of them and each row is written again a few times in its life.

Tasks write files and report them; nothing of them counts before the index file is renamed into place. Files of a task or a
driver that died are in no index and are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

INDEX = "_index"
#: So many index files of a size become one.
FANOUT = 16
#: Rows of a segment file.
SEGMENT_ROWS = 1_000_000

UTC_MICROS = pa.timestamp("us", tz="UTC")
#: Rows of an index file. ``kind`` is segment, end (of a partition after the commit), writer (name and last batch) or marker.
INDEX_FIELDS = pa.schema([
    ("kind", pa.string()), ("version", pa.int64()), ("topic", pa.string()), ("partition", pa.int32()), ("base", pa.int64()), ("end", pa.int64()),
    ("records", pa.int64()), ("least", UTC_MICROS), ("greatest", UTC_MICROS), ("file", pa.string()), ("bytes", pa.int64()), ("txn_id", pa.string()),
    ("outcome", pa.string()), ("epoch", pa.int32())])
INDEX_SCHEMA = ("kind string, version long, topic string, partition int, base long, end long, records long, least timestamp, greatest timestamp, "
                "file string, bytes long, txn_id string, outcome string, epoch int")
SEGMENT_COLUMNS = ["topic", "partition", "base", "end", "records", "least", "greatest", "file", "bytes", "txn_id", "version"]
SEGMENT, END, WRITER, MARKER = "segment", "end", "writer", "marker"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return pafs.LocalFileSystem(), path


@dataclass(frozen=True)
class IndexFile:
    first: int
    last: int
    path: str


@dataclass
class State:
    """A log after a commit: version (-1 before the first), ends by (topic, partition), last batches by writer."""

    version: int
    ends: dict[tuple[str, int], int]
    writers: dict[str, int]


class LogIndex:
    """The index of one log folder. One writer at a time; any number of readers."""

    def __init__(self, path: str):
        self.fs, self.root = opened(path.rstrip("/"))
        self.folder = f"{self.root}/{INDEX}"

    def _all(self) -> list[IndexFile]:
        selector = pafs.FileSelector(self.folder, allow_not_found=True)
        names = (re.fullmatch(r"(\d+)-(\d+)\.parquet", info.base_name) for info in self.fs.get_file_info(selector))
        return sorted((IndexFile(int(m[1]), int(m[2]), f"{self.folder}/{m[0]}") for m in names if m), key=lambda f: (f.first, -f.last))

    def files(self) -> list[IndexFile]:
        """The files that count: none lies within the range of another."""
        out: list[IndexFile] = []
        for f in self._all():
            if not out or f.first > out[-1].last:
                out.append(f)
        return out

    def exists(self) -> bool:
        return bool(self._all())

    def state(self) -> State:
        """From the newest file alone."""
        files = self.files()
        if not files:
            return State(-1, {}, {})
        rows = pq.read_table(files[-1].path, filesystem=self.fs, filters=pc.field("kind").isin([END, WRITER]), columns=["kind", "topic", "partition", "end"]).to_pylist()
        return State(files[-1].last, {(r["topic"], r["partition"]): r["end"] for r in rows if r["kind"] == END},
                     {r["topic"]: r["end"] for r in rows if r["kind"] == WRITER})

    def rows(self, keep: pc.Expression) -> pa.Table:
        """Index rows that an expression picks, read by this process."""
        found = [pq.read_table(f.path, filesystem=self.fs, filters=keep) for f in self.files()]
        return pa.concat_tables(found) if found else INDEX_FIELDS.empty_table()

    def commit(self, segments: Iterable[Mapping], markers: Iterable[Mapping] = (), writer: tuple[str, int] | None = None, after: int | None = None) -> int:
        """Adds one version; with ``after`` only if that is the last one. Returns the new version."""
        state = self.state()
        if after is not None and state.version != after:
            raise RuntimeError(f"the log has moved from version {after} to {state.version}: another writer")
        version = state.version + 1
        added = [{"kind": SEGMENT, "version": version, **s} for s in segments] + [{"kind": MARKER, "version": version, **m} for m in markers]
        for s in added:
            if s["kind"] == SEGMENT:
                place = (s["topic"], s["partition"])
                state.ends[place] = max(state.ends.get(place, 0), s["end"])
        if writer is not None:
            state.writers[writer[0]] = writer[1]
        self._write(version, version, pa.Table.from_pylist(added, INDEX_FIELDS), self._told(state, version))
        self._merge(version, state)
        return version

    @staticmethod
    def _told(state: State, version: int) -> pa.Table:
        rows = [{"kind": END, "version": version, "topic": t, "partition": p, "end": e} for (t, p), e in sorted(state.ends.items())]
        rows += [{"kind": WRITER, "version": version, "topic": name, "end": batch} for name, batch in sorted(state.writers.items())]
        return pa.Table.from_pylist(rows, INDEX_FIELDS)

    def _write(self, first: int, last: int, added: pa.Table, told: pa.Table) -> None:
        """Rows added and the state in row groups of their own, so that either is read without the other."""
        name = f"{self.folder}/{first:012d}-{last:012d}.parquet"
        if self.fs.get_file_info(name).type != pafs.FileType.NotFound:
            raise RuntimeError(f"version {last} of the log is there already: another writer")
        self.fs.create_dir(self.folder, recursive=True)
        draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out, pq.ParquetWriter(out, INDEX_FIELDS) as writer:
            for table in (added, told):
                if table.num_rows:
                    writer.write_table(table)
        self.fs.move(draft, name)

    def _merge(self, version: int, state: State) -> None:
        span = FANOUT
        while (version + 1) % span == 0:
            first = version + 1 - span
            # What an earlier merge replaced goes now; what this one replaces stays for readers that have just listed it.
            live = self.files()
            for f in self._all():
                if f not in live:
                    self.fs.delete_file(f.path)
            parts = [pq.read_table(f.path, filesystem=self.fs, filters=pc.field("kind").isin([SEGMENT, MARKER])) for f in live if f.first >= first]
            self._write(first, version, pa.concat_tables(parts), self._told(state, version))
            span *= FANOUT


# ---- reading by the index -----------------------------------------------------------------------------------------

def index_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the index. It is itself a table, read by Spark, so a log may have any number of segments."""
    uri = path.rstrip("/")
    files = [f"{uri}/{INDEX}/{f.path.rsplit('/', 1)[1]}" for f in LogIndex(path).files()]
    return spark.read.schema(INDEX_SCHEMA).parquet(*files) if files else spark.createDataFrame([], INDEX_SCHEMA)


def log_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: topic, partition, base, end, records, least and greatest time, file, bytes, txn_id, version."""
    return index_table(spark, path).filter(F.col("kind") == SEGMENT).select(*SEGMENT_COLUMNS)


def index_markers(spark: SparkSession, path: str) -> DataFrame:
    """Outcomes of the transactions that committed with their rows: txn_id, outcome, epoch."""
    return index_table(spark, path).filter(F.col("kind") == MARKER).select("txn_id", "outcome", "epoch")


def index_bounds(spark: SparkSession, path: str) -> DataFrame:
    """Begin, end and record count per partition, from the index alone."""
    return log_index(spark, path).groupBy("topic", "partition").agg(F.min("base").alias("begin"), F.max("end").alias("end"), F.sum("records").alias("records"))


def index_ends(spark: SparkSession, path: str) -> DataFrame:
    """End per partition, from the newest index file."""
    ends = LogIndex(path).state().ends
    return spark.createDataFrame([(t, p, e) for (t, p), e in ends.items()], "topic string, partition int, end long")


def read_files(spark: SparkSession, path: str, picked: DataFrame, schema) -> DataFrame:
    """The segments of ``picked`` (a column ``file``) and no others."""
    base = path.rstrip("/")
    files = [f"{base}/{r['file']}" for r in picked.select("file").collect()]
    return spark.read.schema(schema).option("basePath", base).parquet(*files) if files else spark.createDataFrame([], schema)


def time_segments(index: DataFrame, at: Column) -> DataFrame:
    """Per partition the one segment that holds the first record at or after a time; none where all are earlier.

    Times need not rise along a partition: the first segment whose greatest time is late enough has such a record.
    """
    late = index.filter(F.col("greatest") >= at)
    return late.groupBy("topic", "partition").agg(F.min_by("file", "base").alias("file"), F.min("base").alias("base"))


def offsets_for_time_by_index(spark: SparkSession, path: str, at: Column, schema) -> DataFrame:
    """First offset with a timestamp at or after ``at`` per partition, its end where there is none; opens one file a partition."""
    index = log_index(spark, path)
    opened_files = read_files(spark, path, time_segments(index, at), schema)
    found = opened_files.filter(F.col("timestamp") >= at).groupBy("topic", "partition").agg(F.min("offset").alias("first"))
    ends = index.groupBy("topic", "partition").agg(F.max("end").alias("end"))
    return ends.join(found, ["topic", "partition"], "left").select("topic", "partition", F.coalesce("first", "end").alias("start"), "end")


def from_offsets(spark: SparkSession, path: str, starts: DataFrame, schema) -> DataFrame:
    """Rows at or after each partition's ``start``: only segments that reach beyond it are opened."""
    from tidelog.plans.facts import attach, seek

    held = attach(log_index(spark, path), starts.select("topic", "partition", "start"), ["topic", "partition"], "inner")
    return seek(read_files(spark, path, held.filter(F.col("end") > F.col("start")), schema), starts, "start")


def replay_by_index(spark: SparkSession, path: str, schema, from_time: Column | None = None, last: int | None = None) -> DataFrame:
    """Re-read a log from a time, or the last n of each partition, opening the segments that hold them and no others."""
    if from_time is not None:
        return from_offsets(spark, path, offsets_for_time_by_index(spark, path, from_time, schema), schema)
    reach = index_bounds(spark, path)
    start = F.col("begin") if last is None else F.greatest(F.col("begin"), F.col("end") - last)
    return from_offsets(spark, path, reach.select("topic", "partition", start.alias("start")), schema)


def adopt(spark: SparkSession, log: DataFrame, path: str) -> None:
    """Makes an index for a log that was written without one; reads its offsets and times once."""
    index = LogIndex(path)
    if index.exists():
        return
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    place = F.concat(F.lit("topic="), F.substring_index(at, "/topic=", -1))
    rows = log.select("topic", "partition", "offset", "timestamp", place.alias("file"), F.col("_metadata.file_size").alias("bytes")).groupBy("topic", "partition", "file").agg(
        F.min("offset").alias("base"), (F.max("offset") + 1).alias("end"), F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("least"),
        F.max("timestamp").alias("greatest"), F.max("bytes").alias("bytes"))
    index.commit(rows.toArrow().to_pylist())


# ---- the sink -----------------------------------------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    segments: list[dict]


def folder_name(value: str) -> str:
    """A value as the partition folders of Spark's tables spell it."""
    return re.sub(r"[\x00-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value)


class _Segment:
    """A file being written: rows of one partition with offsets in a row."""

    def __init__(self, fs: pafs.FileSystem, root: str, name: str, topic: str, partition: int, base: int, schema: pa.Schema):
        folder = f"topic={folder_name(topic)}/partition={partition}"
        self.fs, self.path, self.file = fs, f"{root}/{folder}/{name}", f"{folder}/{name}"
        self.topic, self.partition, self.base, self.end = topic, partition, base, base
        self.least = self.greatest = None
        fs.create_dir(f"{root}/{folder}", recursive=True)
        self.stream = fs.open_output_stream(self.path)
        self.writer = pq.ParquetWriter(self.stream, schema, compression="zstd")

    def add(self, rows: pa.Table) -> None:
        self.writer.write_table(rows)
        self.end += rows.num_rows
        span = pc.min_max(rows.column("timestamp")).as_py()
        if span["min"] is not None:
            self.least = span["min"] if self.least is None else min(self.least, span["min"])
            self.greatest = span["max"] if self.greatest is None else max(self.greatest, span["max"])

    def close(self) -> dict:
        self.writer.close()
        self.stream.close()
        return {"topic": self.topic, "partition": self.partition, "base": self.base, "end": self.end, "records": self.end - self.base,
                "least": self.least, "greatest": self.greatest, "file": self.file, "bytes": self.fs.get_file_info(self.path).size}


class SegmentWriter(DataSourceArrowWriter):
    """Writes rows sorted by (topic, partition, offset) as segments; the commit puts them into the index."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.txn_id = options["path"], options.get("txn_id")
        self.rows = int(options.get("segment_rows", SEGMENT_ROWS))
        self.after = int(options["after"]) if "after" in options else None
        self.writer = (options["writer"], int(options["batch"])) if "writer" in options else None
        self.outcome, self.epoch = options.get("outcome"), int(options.get("epoch", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.path.rstrip("/"))
        done: list[dict] = []
        current: _Segment | None = None
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            body = table.drop_columns(["topic", "partition"])
            for topic, partition, base, at, n in _runs(table):
                while n:
                    if current and ((current.topic, current.partition, current.end) != (topic, partition, base) or current.end - current.base >= self.rows):
                        done.append(current.close())
                        current = None
                    if current is None:
                        current = _Segment(fs, root, f"{uuid.uuid4().hex}.parquet", topic, partition, base, body.schema)
                    take = min(n, self.rows - (current.end - current.base))
                    current.add(body.slice(at, take))
                    base, at, n = base + take, at + take, n - take
        if current:
            done.append(current.close())
        return Written(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        segments = [{**s, "txn_id": self.txn_id} for m in messages if m for s in m.segments]
        markers = [{"txn_id": self.txn_id, "outcome": self.outcome, "epoch": self.epoch}] if self.outcome else []
        LogIndex(self.path).commit(segments, markers, self.writer, self.after)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = opened(self.path.rstrip("/"))
        for s in (s for m in messages if m for s in m.segments):
            fs.delete_file(f"{root}/{s['file']}")


def _runs(table: pa.Table) -> Iterator[tuple[str, int, int, int, int]]:
    """Stretches of one partition with offsets in a row: topic, partition, first offset, first row, rows."""
    n = table.num_rows
    if not n:
        return
    topic, partition, offset = (table.column(c).combine_chunks() for c in ("topic", "partition", "offset"))
    breaks = [0]
    if n > 1:
        same = pc.and_(pc.and_(pc.equal(topic[1:], topic[:-1]), pc.equal(partition[1:], partition[:-1])), pc.equal(pc.subtract(offset[1:], offset[:-1]), 1))
        breaks += [i + 1 for i in pc.indices_nonzero(pc.invert(same)).to_pylist()]
    for at, upto in zip(breaks, [*breaks[1:], n], strict=True):
        yield topic[at].as_py(), partition[at].as_py(), offset[at].as_py(), at, upto - at


def sweep(path: str) -> int:
    """Deletes data files that are in no index, of tasks and drivers that died; nobody may be writing. Returns how many."""
    index = LogIndex(path)
    known = set(index.rows(pc.field("kind") == SEGMENT).column("file").to_pylist())
    gone = 0
    for info in index.fs.get_file_info(pafs.FileSelector(index.root, recursive=True, allow_not_found=True)):
        place = info.path[len(index.root):].lstrip("/")
        if info.is_file and place.startswith("topic=") and place.endswith(".parquet") and place not in known:
            index.fs.delete_file(info.path)
            gone += 1
    return gone


class SegmentLog(DataSource):
    """``format("tidelog")``: a sink for logs with a segment index, and a stream source whose offsets are those of the log."""

    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self):
        from tidelog.sources.log import LOG_SCHEMA

        return LOG_SCHEMA

    def writer(self, schema, overwrite: bool) -> SegmentWriter:
        if overwrite:
            raise ValueError("a log is appended to, not overwritten")
        return SegmentWriter(self.options)

    def streamReader(self, schema):
        from tidelog.streaming.source import SegmentStreamReader

        return SegmentStreamReader(self.options)


def registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(SegmentLog)
    return spark


def write_segments(rows: DataFrame, path: str, after: int, txn_id: str | None = None, segment_rows: int = SEGMENT_ROWS,
                   writer: tuple[str, int] | None = None, outcome: str | None = None, epoch: int = 0, by: Sequence[str] = ("topic", "partition", "offset")) -> None:
    """Rows with their offsets, as segments, visible all at once. ``after`` is the version whose ends the offsets continue."""
    registered(rows.sparkSession)
    out = rows.sortWithinPartitions(*by).write.format("tidelog").mode("append").option("path", path).option("after", after).option("segment_rows", segment_rows)
    if txn_id is not None:
        out = out.option("txn_id", txn_id)
    if writer is not None:
        out = out.option("writer", writer[0]).option("batch", writer[1])
    if outcome is not None:
        out = out.option("outcome", outcome).option("epoch", epoch)
    out.save()

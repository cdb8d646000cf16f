"""A stream source over a segment index: offsets per partition, micro-batches bounded by rows, a rate and a wait.

An offset of the source is {"topic/partition": next offset}, as a consumer's. How far a micro-batch goes is decided here: at
most ``max_rows`` records, shared out by what each partition still holds; no more than ``rows_per_second`` allow since the
source began; and none until ``min_rows`` are there or ``max_wait_s`` have passed. A batch opens only the segments that hold
its offsets, one task each, or one for every ``slice_rows`` offsets.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidelog.sources.log import LOG_SCHEMA, start_policy
from tidelog.sources.segments import SEGMENT, LogIndex, index_bounds, index_ends, opened, registered

Offsets = dict[str, int]


def place_name(topic: str, partition: int) -> str:
    return f"{topic}/{partition}"


def place_of(name: str) -> tuple[str, int]:
    topic, _, partition = name.rpartition("/")
    return topic, int(partition)


def share_out(held: Mapping[str, int], most: int) -> dict[str, int]:
    """How many of ``most`` records each place gives, by what it holds; all of them if there are no more.

    Rounded down, then one more each, those with the largest rests first and ties by name, until ``most`` are given.
    """
    total = sum(held.values())
    if total <= most:
        return dict(held)
    given = {p: n * most // total for p, n in held.items()}
    rest = sorted(held, key=lambda p: (-(held[p] * most % total), p))
    for p in rest[:most - sum(given.values())]:
        given[p] += 1
    return given


@dataclass
class SegmentSlice(InputPartition):
    file: str
    topic: str
    partition: int
    start: int
    stop: int


class SegmentStreamReader(DataSourceStreamReader):
    """See the module. Options: path, topic, starts (JSON of offsets), max_rows, min_rows, max_wait_s, rows_per_second, slice_rows."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.topic = options["path"], options.get("topic")
        self.starts: Offsets = json.loads(options.get("starts", "{}"))
        number = lambda name: float(options[name]) if name in options else None
        self.max_rows, self.min_rows, self.max_wait = number("max_rows"), number("min_rows"), number("max_wait_s")
        self.rate, self.slice_rows = number("rows_per_second"), number("slice_rows")
        self.index = LogIndex(self.path)
        self.at: Offsets | None = None
        self.given = 0
        self.began = self.waiting_since = None

    def initialOffset(self) -> Offsets:
        return dict(self.starts)

    def _held(self, at: Offsets) -> Offsets:
        ends = {place_name(t, p): e for (t, p), e in self.index.state().ends.items() if self.topic is None or t == self.topic}
        return {p: e - at.get(p, 0) for p, e in sorted(ends.items()) if e > at.get(p, 0)}

    def latestOffset(self) -> Offsets:
        now = time.monotonic()
        self.began = now if self.began is None else self.began
        at = dict(self.starts) if self.at is None else self.at
        held = self._held(at)
        there = sum(held.values())
        if self.min_rows and 0 < there < self.min_rows:
            self.waiting_since = now if self.waiting_since is None else self.waiting_since
            if self.max_wait is None or now - self.waiting_since < self.max_wait:
                return at
        self.waiting_since = None
        most = there if self.max_rows is None else min(there, int(self.max_rows))
        if self.rate is not None:
            most = max(0, min(most, int(self.rate * (now - self.began)) - self.given))
        given = share_out(held, most)
        self.given += sum(given.values())
        self.at = at | {p: at.get(p, 0) + n for p, n in given.items() if n}
        return self.at

    def partitions(self, start: Offsets, end: Offsets) -> list[SegmentSlice]:
        # After a restart the engine asks for the slices of the last offset it knows, before anything else.
        if self.at is None:
            self.at = dict(end)
        wanted = {place_of(p): (start.get(p, self.starts.get(p, 0)), stop) for p, stop in end.items() if stop > start.get(p, self.starts.get(p, 0))}
        if not wanted:
            return []
        low, high = min(a for a, _ in wanted.values()), max(b for _, b in wanted.values())
        keep = (pc.field("kind") == SEGMENT) & (pc.field("end") > low) & (pc.field("base") < high) & pc.field("topic").isin(sorted({t for t, _ in wanted}))
        out = []
        for s in self.index.rows(keep).select(["file", "topic", "partition", "base", "end"]).to_pylist():
            a, b = wanted.get((s["topic"], s["partition"]), (0, 0))
            if s["end"] > a and s["base"] < b:
                out += self._slices(s["file"], s["topic"], s["partition"], max(a, s["base"]), min(b, s["end"]))
        return out

    def _slices(self, file: str, topic: str, partition: int, start: int, stop: int) -> list[SegmentSlice]:
        """Tasks end at multiples of ``slice_rows``, wherever a segment or a batch begins."""
        step = int(self.slice_rows) if self.slice_rows else stop
        cuts = [start, *range((start // step + 1) * step, stop, step), stop]
        return [SegmentSlice(file, topic, partition, a, b) for a, b in zip(cuts, cuts[1:], strict=False)]

    def read(self, partition: SegmentSlice) -> Iterator[pa.RecordBatch]:
        fs, root = opened(self.path.rstrip("/"))
        schema = to_arrow_schema(LOG_SCHEMA)
        # Row groups, and pages within them, that hold other offsets are passed over.
        inside = (pc.field("offset") >= partition.start) & (pc.field("offset") < partition.stop)
        rows = pq.read_table(f"{root}/{partition.file}", filesystem=fs, filters=inside, partitioning=None)
        rows = rows.append_column("topic", pa.repeat(partition.topic, rows.num_rows)).append_column("partition", pa.array([partition.partition] * rows.num_rows, pa.int32()))
        yield from rows.select(schema.names).cast(schema).to_batches(max_chunksize=10_000)


def log_stream(spark: SparkSession, path: str, topic: str | None = None, max_rows: int | None = None, min_rows: int | None = None,
               max_wait_s: float | None = None, rows_per_second: float | None = None, starts: Mapping[str, int] | None = None,
               slice_rows: int | None = None) -> DataFrame:
    """A log with a segment index as a stream, from ``starts`` ({"topic/partition": offset}, others from their begin at 0)."""
    reader = registered(spark).readStream.format("tidelog").option("path", path)
    given = {"topic": topic, "max_rows": max_rows, "min_rows": min_rows, "max_wait_s": max_wait_s, "rows_per_second": rows_per_second, "slice_rows": slice_rows}
    reader = reader.options(**{k: str(v) for k, v in given.items() if v is not None})
    return reader.option("starts", json.dumps(dict(starts or {}))).load()


def stream_starts(spark: SparkSession, path: str, commits: DataFrame, policy: str = "earliest", group: str | None = None) -> Offsets:
    """Starting offsets of a group for ``log_stream``, by its commits and the policy: one entry per partition of the index."""
    rows = start_policy(index_bounds(spark, path), commits, policy, group).select("topic", "partition", "start").collect()
    return {place_name(r["topic"], r["partition"]): r["start"] for r in rows}


def reached(query: StreamingQuery) -> Offsets:
    """Offsets up to which a query of one log stream has finished its work."""
    told = query.lastProgress
    sources = json.loads(told.json)["sources"] if told else []
    end = sources[0]["endOffset"] if sources else None
    return (json.loads(end) if isinstance(end, str) else end) or {}


def drain_log(writer: DataStreamWriter, path: str, topic: str | None = None, timeout_s: float | None = None) -> StreamingQuery:
    """Run a query of one log stream until it has done what the log held at the start, then stop it.

    ``availableNow`` would take a single micro-batch: the engine asks a Python source for its latest offset once. So the query
    runs trigger by trigger, each bounded by the source, until its progress reaches the ends.
    """
    ends = {place_name(t, p): e for (t, p), e in LogIndex(path).state().ends.items() if topic is None or t == topic}
    query = writer.trigger(processingTime="0 seconds").start()
    limit = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while any(reached(query).get(p, 0) < e for p, e in ends.items()):
            if query.exception() is not None:
                raise query.exception()
            if limit is not None and time.monotonic() > limit:
                raise TimeoutError(f"not drained within {timeout_s} s")
            time.sleep(0.02)
    finally:
        query.stop()
    return query


def log_lag(spark: SparkSession, path: str, progress: DataFrame) -> DataFrame:
    """Records that a query of one log stream had still to read after each micro-batch of its progress table, by partition.

    The progress has the real offsets; the ends are those of the index now. Rows: (query, run, batch_id, topic, partition,
    position, end, lag). A partition has rows from the first batch on that read of it.
    """
    offsets = F.from_json(F.get_json_object("end_offset", "$[0]"), "map<string, bigint>")
    told = progress.select("query", "run", "batch_id", F.explode(offsets).alias("place", "position"))
    ends = index_ends(spark, path).withColumn("place", F.concat("topic", F.lit("/"), F.col("partition").cast("string")))
    return told.join(ends, "place").select("query", "run", "batch_id", "topic", "partition", "position", "end", (F.col("end") - F.col("position")).alias("lag"))

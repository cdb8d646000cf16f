"""Handled offsets as runs: a ledger whose size grows with the gaps between handled records, not with the records.

A run is (topic, partition, begin, end): every offset from ``begin`` up to, not including, ``end`` is handled. Offsets become
runs chunk by chunk, and runs of several chunks or batches are merged by a sweep over their borders: one begins a run, minus
one ends it, borders of the same place cancel out, so what touches or overlaps becomes one run. The done watermark of a
partition is then the end of the run that holds its begin, and whether a record is handled is a question about the last run
that begins at or before it.

Topic and partition may be null and then form groups like any others; a null offset is in no run and never handled.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.plans import scans
from tidelog.plans.once import materialised
from tidelog.plans.scans import CHUNK
from tidelog.sources.segments import FANOUT, opened

PART = ["topic", "partition"]
RUNS = "_runs"
RUN_SCHEMA = "topic string, partition int, begin long, end long"


def merge_runs(runs: DataFrame, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Runs that overlap or touch made one. Empty runs (``end`` not after ``begin``) go."""
    border = lambda column, step: F.struct(F.col(column).alias("at"), F.lit(step).cast("bigint").alias("step"))
    borders = runs.filter(F.col("begin") < F.col("end")).select(*PART, F.inline(F.array(border("begin", 1), border("end", -1))))
    changes = materialised(borders.groupBy(*PART, "at").agg(F.sum("step").alias("step")).filter(F.col("step") != 0))
    chunk = scans.id_chunk("at", chunk_rows)
    depth = scans.scan(changes, PART, ["at"], chunk, depth=scans.running_sum(F.col("step")))
    # A run begins where nothing was open before, and ends where nothing is open after: the two take turns.
    outer = materialised(depth.filter((F.col("depth") == 0) | (F.col("depth") == F.col("step"))).select(*PART, "at", "depth"))
    paired = scans.scan(outer, PART, ["at"], chunk, end=scans.following(F.col("at")))
    return paired.filter(F.col("depth") > 0).select(*PART, F.col("at").alias("begin"), "end")


def runs_of(done: DataFrame, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """The runs of a table of handled positions, in any order and any number of copies."""
    places = done.select(*PART, "offset").filter(F.col("offset").isNotNull()).distinct().withColumn(CHUNK, scans.id_chunk("offset", chunk_rows))
    inside = Window.partitionBy(*PART, CHUNK).orderBy("offset")
    islands = places.withColumn("__island", F.col("offset") - F.row_number().over(inside)).groupBy(*PART, CHUNK, "__island").agg(
        F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"))
    return merge_runs(islands, chunk_rows)


def skip_runs(df: DataFrame, runs: DataFrame, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Rows whose position is in no run, one per position.

    Runs are cut at the borders of chunks and sorted in among the rows of their chunk, where the furthest end so far tells
    whether a row is covered. The rows are read once, and no chunk inherits anything from another. ``runs`` may overlap.
    """
    rows = F.lit(chunk_rows)
    cut = runs.filter(F.col("begin") < F.col("end")).select(
        *PART, "begin", "end", F.explode(F.sequence(F.floor(F.col("begin") / rows), F.floor((F.col("end") - 1) / rows))).alias(CHUNK))
    pieces = cut.select(*PART, CHUNK, F.greatest("begin", F.col(CHUNK) * rows).alias("offset"), F.lit(0).alias("__row"), F.col("end").alias("__end"))
    asked = df.dropDuplicates([*PART, "offset"]).withColumns({
        CHUNK: scans.id_chunk("offset", chunk_rows), "__row": F.lit(1), "__end": F.lit(None).cast("bigint")})
    so_far = Window.partitionBy(*PART, CHUNK).orderBy("offset", "__row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = asked.unionByName(pieces, allowMissingColumns=True).withColumn("__upto", F.max("__end").over(so_far))
    free = F.coalesce(F.col("__upto") <= F.col("offset"), F.lit(True))
    return covered.filter((F.col("__row") == 1) & free).select(*df.columns)


def watermark_of_runs(log_bounds: DataFrame, runs: DataFrame) -> DataFrame:
    """Per partition the first offset that is not done, its end when all are: no row of the log is read.

    ``log_bounds`` has (topic, partition, begin, end), as ``segments.index_bounds`` tells; ``runs`` are merged. Offsets that
    the log skips count as not done.
    """
    known = log_bounds.select(*PART, F.col("begin").alias("__from"), F.col("end").alias("__to"))
    first = scans.join_null_safe(known, runs, PART).filter((F.col("begin") <= F.col("__from")) & (F.col("end") > F.col("__from")))
    reach = first.groupBy(*PART).agg(F.max("end").alias("__reach"))
    return scans.join_null_safe(known, reach, PART, how="left").select(
        *PART, F.least(F.coalesce("__reach", "__from"), "__to").alias("watermark"), F.col("__to").alias("end"))


@dataclass(frozen=True)
class Version:
    first: int
    last: int
    name: str


class RunLedger:
    """A stored ledger: every ``add`` leaves the runs of a batch, and so many of them are merged into one.

    A version counts from the moment its small marker file is there; data of an attempt that died is named by no marker and is
    not read. A merged version replaces those it was made of, whose data goes with the merge after that, so frames that were
    read before a merge stay good until then. One writer at a time; any number of readers.
    """

    def __init__(self, spark: SparkSession, path: str, chunk_rows: int = scans.CHUNK_ROWS):
        self.spark, self.chunk_rows = spark, chunk_rows
        self.base = f"{path.rstrip('/')}/{RUNS}"
        self.fs, self.folder = opened(self.base)

    def _all(self) -> list[Version]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.folder}/markers", allow_not_found=True))
        names = (re.fullmatch(r"(\d+)-(\d+)-([0-9a-f]+)", info.base_name) for info in found)
        return sorted((Version(int(m[1]), int(m[2]), m[0]) for m in names if m), key=lambda v: (v.first, -v.last, v.name))

    def versions(self) -> list[Version]:
        """Those that count: none lies within the range of another."""
        out: list[Version] = []
        for v in self._all():
            if not out or v.first > out[-1].last:
                out.append(v)
        return out

    def exists(self) -> bool:
        return bool(self._all())

    def _read(self, versions: list[Version]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(*[f"{self.base}/data/{v.name}" for v in versions])

    def parts(self) -> DataFrame:
        """All runs as they are stored; those of different versions may touch or overlap."""
        return self._read(self.versions())

    def runs(self) -> DataFrame:
        """All runs, merged."""
        return merge_runs(self.parts(), self.chunk_rows)

    def _write(self, first: int, last: int, runs: DataFrame) -> Version:
        version = Version(first, last, f"{first:012d}-{last:012d}-{uuid.uuid4().hex}")
        runs.select(*[F.col(f.name).cast(f.dataType) for f in self._read([]).schema]).write.parquet(f"{self.base}/data/{version.name}")
        self.fs.create_dir(f"{self.folder}/markers", recursive=True)
        with self.fs.open_output_stream(f"{self.folder}/markers/{version.name}"):
            pass
        return version

    def add(self, runs: DataFrame) -> int:
        """Adds a batch's runs as one version and returns its number."""
        live = self.versions()
        number = live[-1].last + 1 if live else 0
        live.append(self._write(number, number, runs))
        span = FANOUT
        if (number + 1) % span == 0:
            for replaced in [v for v in self._all() if v not in live]:
                self.fs.delete_file(f"{self.folder}/markers/{replaced.name}")
                self.fs.delete_dir(f"{self.folder}/data/{replaced.name}")
        while (number + 1) % span == 0:
            first = number + 1 - span
            merged = self._write(first, number, merge_runs(self._read([v for v in live if v.first >= first]), self.chunk_rows))
            live = [v for v in live if v.first < first] + [merged]
            span *= FANOUT
        return number


def union_runs(*runs: DataFrame, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Several ledgers as one."""
    return merge_runs(reduce(DataFrame.unionByName, runs), chunk_rows)

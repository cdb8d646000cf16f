"""The segment index, its sink and its stream source: commits, crashes, what a replay opens, bounds of micro-batches."""

import glob
import json
import os

import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.sources import log as source
from tidelog.sources import segments as sg
from tidelog.sources import sinks
from tidelog.streaming import deliver as d
from tidelog.streaming import source as ls


def rows(spark, n, partitions=3, topic="t", at=0):
    return spark.range(at, at + n).select(
        F.lit(topic).alias("topic"), (F.col("id") % partitions).cast("int").alias("partition"), F.timestamp_seconds(F.col("id") * 10).alias("timestamp"),
        F.col("id").cast("string").alias("key"), F.col("id").cast("string").cast("binary").alias("value"), F.col("id").alias("seq"))


def held(spark, path):
    return sorted((r.topic, r.partition, r.offset, r.key) for r in source.read_log(spark, path).collect())


def expected(n, partitions=3, topic="t"):
    return sorted((topic, i % partitions, i // partitions, str(i)) for i in range(n))


def test_appends_continue_and_the_index_tells_all(spark, folder):
    for k in range(3):
        source.append_log(rows(spark, 40, at=40 * k), folder, "seq", 3, max_rows_per_file=7)
    assert held(spark, folder) == expected(120)
    index = sg.log_index(spark, folder)
    assert {(r.partition, r.begin, r.end, r.records) for r in sg.index_bounds(spark, folder).collect()} == {(p, 0, 40, 40) for p in range(3)}
    assert {(r.partition, r.end) for r in sg.index_ends(spark, folder).collect()} == {(p, 40) for p in range(3)}
    assert index.filter("records > 7 or end - base <> records").count() == 0
    # Every row of the index tells of its file what the file holds.
    files = source.read_log(spark, folder).groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"(topic=.*)$", 1).alias("file")).agg(
        F.min("offset").alias("b"), (F.max("offset") + 1).alias("e"), F.min("timestamp").alias("l"), F.max("timestamp").alias("g"))
    assert index.join(files, "file").filter("base = b and end = e and least = l and greatest = g").count() == index.count() == files.count()


def test_each_row_is_worked_out_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def look(x):
        seen.add(1)
        return x

    watched = rows(spark, 500).withColumn("key", F.udf(look, "string")("key")).withColumn("partition", F.when(F.col("seq") % 50 == 0, None).otherwise(F.col("partition")))
    refused = source.append_log(watched, folder, "seq", 3)
    assert refused.count() == 10 and seen.value == 500
    sinks.atomic_append({"a": watched.filter("partition is not null").drop("topic"), "b": rows(spark, 30).drop("topic")}, folder, None, "t9", "seq", 3)
    assert seen.value <= 1000 and source.read_log(spark, folder).count() == 490 + 490 + 30
    assert [tuple(r) for r in sg.index_markers(spark, folder).collect()] == [("t9", "commit", 0)]


def test_all_or_nothing(spark, folder):
    source.append_log(rows(spark, 9), folder, "seq", 3)
    with pytest.raises(ValueError, match="out of range"):
        sinks.atomic_append({"a": rows(spark, 5).drop("topic"), "b": rows(spark, 50, partitions=5).drop("topic")}, folder, None, "t1", "seq", 3)
    assert held(spark, folder) == expected(9) and sg.index_markers(spark, folder).count() == 0


def test_a_task_that_dies_and_a_driver_that_dies_leave_nothing_visible(spark, folder):
    class DyingTask(sg.SegmentWriter):
        def write(self, iterator):
            told = super().write(iterator)
            if any(s["partition"] == 1 for s in told.segments):
                raise RuntimeError("killed task")
            return told

    class DyingDriver(sg.SegmentWriter):
        def commit(self, messages):
            raise SystemError("killed driver")

        def abort(self, messages):
            pass

    def source_of(kind, label):
        class Dying(sg.SegmentLog):
            @classmethod
            def name(cls):
                return label

            def writer(self, schema, overwrite):
                return kind(self.options)
        return Dying

    source.append_log(rows(spark, 30), folder, "seq", 3)
    more = source.with_log_columns(rows(spark, 30, at=30).withColumn("offset", F.floor(F.col("seq") / 3)))
    for kind, label in ((DyingTask, "dying-task"), (DyingDriver, "dying-driver")):
        spark.dataSource.register(source_of(kind, label))
        with pytest.raises(Exception, match="killed"):
            more.repartition(3, "partition").sortWithinPartitions("partition", "offset").write.format(label).mode("append").option("path", folder).option("after", 0).save()
        assert held(spark, folder) == expected(30)
    assert len(glob.glob(f"{folder}/topic=t/*/*.parquet")) > sg.log_index(spark, folder).count()
    assert sg.sweep(folder) > 0
    assert len(glob.glob(f"{folder}/topic=t/*/*.parquet")) == sg.log_index(spark, folder).count()
    source.append_log(rows(spark, 30, at=30), folder, "seq", 3)
    assert held(spark, folder) == expected(60)


def test_a_second_writer_is_refused(spark, folder):
    source.append_log(rows(spark, 30), folder, "seq", 3)
    stale = source.with_log_columns(rows(spark, 3).withColumn("offset", F.lit(99).cast("long")))
    with pytest.raises(Exception, match="another writer"):
        sg.write_segments(stale, folder, after=-1)
    assert held(spark, folder) == expected(30)


def test_names_that_folders_cannot_hold(spark, folder):
    for topic in ("a/b c=%é:x", "über", "a%2Fb"):
        source.append_log(rows(spark, 6, topic=topic), folder, "seq", 3)
        assert source.read_log(spark, folder, topic).count() == 6
    assert {r.topic for r in source.read_log(spark, folder).select("topic").distinct().collect()} == {"a/b c=%é:x", "über", "a%2Fb"}
    assert sg.sweep(folder) == 0


def test_empty_appends_and_null_times(spark, folder):
    source.append_log(rows(spark, 0), folder, "seq", 3)
    assert source.read_log(spark, folder).count() == 0 and sg.index_bounds(spark, folder).count() == 0
    source.append_log(rows(spark, 6).withColumn("timestamp", F.lit(None).cast("timestamp")), folder, "seq", 3)
    assert held(spark, folder) == expected(6)
    assert {(r.start, r.end) for r in sg.offsets_for_time_by_index(spark, folder, F.timestamp_seconds(F.lit(0)), source.LOG_SCHEMA).collect()} == {(2, 2)}


def test_a_log_without_an_index_gets_one(spark, folder):
    old = source.with_log_columns(rows(spark, 30, topic="a b").withColumn("offset", F.floor(F.col("seq") / 3)))
    old.write.partitionBy("topic", "partition").parquet(folder + "/log")
    source.append_log(rows(spark, 30, topic="a b", at=30), folder + "/log", "seq", 3)
    assert held(spark, folder + "/log") == expected(60, topic="a b")


def test_a_replay_opens_as_many_files_however_long_the_log(spark, folder):
    counts = []
    for appends in (6, 12):
        path = f"{folder}/{appends}"
        for k in range(appends):
            source.append_log(rows(spark, 30, at=30 * k), path, "seq", 3)
        n = 30 * appends
        late = sg.replay_by_index(spark, path, source.LOG_SCHEMA, from_time=F.timestamp_seconds(F.lit(10 * (n - 15))))
        last = sg.replay_by_index(spark, path, source.LOG_SCHEMA, last=4)
        assert sorted(r.key for r in late.collect()) == sorted(str(i) for i in range(n - 15, n))
        assert sorted(r.key for r in last.collect()) == sorted(str(i) for i in range(n - 12, n))
        starts = sg.time_segments(sg.log_index(spark, path), F.timestamp_seconds(F.lit(155)))
        assert starts.count() == 3 and {r.base for r in starts.collect()} == {0}
        counts.append((len(late.inputFiles()), len(last.inputFiles())))
    assert counts[0] == counts[1] == (3, 3)


def test_times_out_of_order(spark, folder):
    """The first segment with a late time holds the first late record, though a later segment's times are all early."""
    for k, second in enumerate((0, 100, 5, 200)):
        source.append_log(rows(spark, 3, partitions=1, at=3 * k).withColumn("timestamp", F.timestamp_seconds(F.lit(second))), folder, "seq", 1)
    found = sg.offsets_for_time_by_index(spark, folder, F.timestamp_seconds(F.lit(50)), source.LOG_SCHEMA).collect()
    assert [(r.start, r.end) for r in found] == [(3, 12)]


def test_hundreds_of_commits_cost_in_proportion(folder, monkeypatch):
    written = []
    real = sg.LogIndex._write
    monkeypatch.setattr(sg.LogIndex, "_write", lambda self, a, b, added, told: (written.append(added.num_rows), real(self, a, b, added, told)))
    index, n = sg.LogIndex(folder), 600
    for k in range(n):
        index.commit([{"topic": "t", "partition": k % 2, "base": k // 2, "end": k // 2 + 1, "records": 1, "file": f"f{k}"}], writer=("w", k), after=k - 1)
    assert index.state() == sg.State(n - 1, {("t", 0): 300, ("t", 1): 300}, {"w": n - 1})
    assert sorted(index.rows(pc.field("kind") == sg.SEGMENT).column("file").to_pylist()) == sorted(f"f{k}" for k in range(n))
    # A row is written once, and again for each power of the fan-out that its file reaches.
    assert sum(written) <= 3 * n and len(index.files()) <= 3 * sg.FANOUT and len(os.listdir(folder + "/_index")) <= 6 * sg.FANOUT


def test_a_batch_that_ran_before_its_checkpoint_is_in_the_log_once(spark, folder, monkeypatch):
    rows(spark, 90).coalesce(3).write.parquet(folder + "/in")
    real, died = d.append_log, []

    def dies_after(batch, *args, **more):
        out = real(batch, *args, **more)
        if not died:
            died.append(1)
            raise RuntimeError("after the commit")
        return out

    monkeypatch.setattr(d, "append_log", dies_after)
    schema = spark.read.parquet(folder + "/in").schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    with pytest.raises(Exception, match="after the commit"):
        d.drain(d.append_segments_stream(stream(), folder + "/log", "copy", "seq", 3, folder + "/checkpoint"))
    d.drain(d.append_segments_stream(stream(), folder + "/log", "copy", "seq", 3, folder + "/checkpoint"))
    log = source.read_log(spark, folder + "/log")
    assert log.count() == 90 and log.select("key").distinct().count() == 90 and log.select("partition", "offset").distinct().count() == 90
    assert sg.LogIndex(folder + "/log").state().writers == {"copy": 2} and sg.index_markers(spark, folder + "/log").count() == 3


@given(st.dictionaries(st.text(max_size=3), st.integers(1, 10**12), max_size=8), st.integers(0, 10**12))
@settings(max_examples=200, deadline=None)
def test_shares_add_up(held, most):
    given_ = ls.share_out(held, most)
    assert sum(given_.values()) == min(most, sum(held.values())) and all(0 <= given_[p] <= held[p] for p in held)


def test_a_stream_stopped_between_batches_goes_on_where_it_was(spark, folder):
    source.append_log(rows(spark, 200), folder + "/log", "seq", 3, max_rows_per_file=11)
    effects = lambda: d.deliver(ls.log_stream(spark, folder + "/log", "t", max_rows=30), d.append_effect(folder + "/out"), d.AT_LEAST_ONCE, folder + "/checkpoint")
    running = effects().trigger(processingTime="300 milliseconds").start()
    while sum(ls.reached(running).values()) < 60:
        assert running.exception() is None
    running.stop()
    before = spark.read.parquet(folder + "/out").select("batch_id").distinct().count()
    source.append_log(rows(spark, 100, at=200), folder + "/log", "seq", 3)
    ls.drain_log(effects(), folder + "/log", "t", timeout_s=120)
    out = spark.read.parquet(folder + "/out")
    sizes = [r["count"] for r in out.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert before >= 2 and max(sizes) <= 30
    # The interrupted batch may run twice; its offsets are the same.
    assert out.select("partition", "offset").distinct().count() == 300
    assert sorted(r.key for r in out.select("key").distinct().collect()) == sorted(map(str, range(300)))


def test_a_batch_waits_for_enough_rows_but_not_for_ever(folder):
    index = sg.LogIndex(folder)
    index.commit([{"topic": "t", "partition": 0, "base": 0, "end": 5, "records": 5, "file": "f"}])
    patient = ls.SegmentStreamReader({"path": folder, "min_rows": "10"})
    assert patient.latestOffset() == {}
    index.commit([{"topic": "t", "partition": 1, "base": 0, "end": 5, "records": 5, "file": "g"}])
    assert patient.latestOffset() == {"t/0": 5, "t/1": 5}
    hasty = ls.SegmentStreamReader({"path": folder, "min_rows": "11", "max_wait_s": "0"})
    assert hasty.latestOffset() == {"t/0": 5, "t/1": 5}


def test_slices_are_those_of_the_offsets(folder):
    index = sg.LogIndex(folder)
    index.commit([{"topic": "t", "partition": 0, "base": b, "end": b + 10, "records": 10, "file": f"f{b}"} for b in range(0, 100, 10)])
    reader = ls.SegmentStreamReader({"path": folder, "starts": json.dumps({"t/0": 25})})
    assert reader.initialOffset() == {"t/0": 25}
    got = reader.partitions({"t/0": 25}, {"t/0": 41})
    assert [(s.file, s.start, s.stop) for s in got] == [("f20", 25, 30), ("f30", 30, 40), ("f40", 40, 41)]
    assert reader.partitions({"t/0": 41}, {"t/0": 41}) == []


def test_a_group_starts_at_its_commits(spark, folder):
    source.append_log(rows(spark, 30), folder, "seq", 3)
    commits = spark.createDataFrame([("t", 0, 4)], "topic string, partition int, committed long")
    assert ls.stream_starts(spark, folder, commits, "latest") == {"t/0": 4, "t/1": 10, "t/2": 10}
    stream = ls.log_stream(spark, folder, starts=ls.stream_starts(spark, folder, commits, "latest"))
    ls.drain_log(d.deliver(stream, d.append_effect(folder + "-out"), d.AT_LEAST_ONCE, folder + "-checkpoint"), folder, timeout_s=60)
    assert sorted((r.partition, r.offset) for r in spark.read.parquet(folder + "-out").collect()) == [(0, o) for o in range(4, 10)]

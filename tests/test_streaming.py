"""Streams over at least three files, with crashes injected, against their batch twins."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog.operators import failures, queue
from tidelog.sources import generate, log as source, sinks
from tidelog.streaming import deliver as d
from tidelog.streaming import progress, state


def write_records(spark, folder, n, per_file, reverse=False):
    """One file per ``per_file`` consecutive records of one partition; file times give the order."""
    path = folder + "/in"
    starts = list(range(0, n, per_file))
    for i, lo in enumerate(starts):
        rows = spark.range(lo, min(n, lo + per_file), 1, 1).select(
            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
            F.timestamp_micros(F.col("id") * 1000).alias("timestamp"), F.concat(F.lit("k-"), F.col("id").cast("string")).alias("key"),
            F.concat(F.lit("v"), F.col("id").cast("string")).cast("binary").alias("value"))
        source.with_log_columns(rows).write.mode("append").parquet(path)
        when = 1_700_000_000 + (len(starts) - i if reverse else i) * 10
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 1_750_000_000:
                os.utime(full, (when, when))
    return path


class Crash(Exception):
    pass


def crash_run(spark, folder, mode, n=3000, size=500, crash_after=1234):
    """Handle record batches, die after ``crash_after`` records in the middle of one, then restart."""
    path = write_records(spark, folder, n, size)
    effects = folder + "/effects"
    append = d.append_effect(effects)
    crashed = {"left": crash_after}

    def handle(batch, batch_id):
        if crashed["left"] is None:
            return append(batch, batch_id)
        rows = batch.count()
        if rows <= crashed["left"]:
            crashed["left"] -= rows
            return append(batch, batch_id)
        append(batch.orderBy("offset").limit(crashed["left"]), batch_id)
        crashed["left"] = None
        raise Crash("in the middle of a batch")

    def writer():
        stream = source.read_log_stream(spark, path, files_per_trigger=1)
        return d.deliver(stream, handle, mode, folder + "/checkpoint", started=folder + "/started", ledger=d.effect_ledger(effects))

    with pytest.raises(StreamingQueryException):
        d.drain(writer())
    first = spark.read.parquet(effects).count()
    d.drain(writer())
    seen = spark.read.parquet(effects).groupBy("offset").count()
    total = seen.agg(F.sum("count"), F.count("*"), F.count_if(F.col("count") > 1)).first()
    return first, total[0] - first, total[1], n - total[1], total[2]


def test_commit_before_handling(spark, folder):
    assert crash_run(spark, folder, d.AT_MOST_ONCE) == (1234, 1500, 2734, 266, 0)


def test_commit_after_handling(spark, folder):
    assert crash_run(spark, folder, d.AT_LEAST_ONCE) == (1234, 2000, 3000, 0, 234)


def test_commit_after_handling_idempotent(spark, folder):
    assert crash_run(spark, folder, d.EFFECTIVELY_ONCE) == (1234, 1766, 3000, 0, 0)


def test_exactly_once_across_a_crash(spark, folder):
    path = write_records(spark, folder, 2000, 250)
    out, checkpoint = folder + "/out", folder + "/checkpoint"
    stream = lambda: source.read_log_stream(spark, path, files_per_trigger=1)
    upper = lambda s: s.select("key", F.upper(F.col("value").cast("string")).alias("value"))

    def failing(s):
        boom = F.when(F.col("offset") == 1100, F.raise_error(F.lit("crash")).cast("string")).otherwise(F.upper(F.col("value").cast("string")))
        return s.select("key", boom.alias("value"))

    with pytest.raises(StreamingQueryException):
        d.drain(d.exactly_once(stream(), failing, out, checkpoint))
    partial = spark.read.parquet(out).count()
    assert partial == 1000
    d.drain(d.exactly_once(stream(), upper, out, checkpoint))
    r = spark.read.parquet(out).agg(F.count("*"), F.countDistinct("key", "value")).first()
    assert tuple(r) == (2000, 2000)


def test_dedup_over_shuffled_files_keeps_every_id(spark, folder):
    path = write_records(spark, folder, 1000, 250, reverse=True)
    stream = source.read_log_stream(spark, path, files_per_trigger=1)
    again = stream.unionByName(source.read_log_stream(spark, path, files_per_trigger=2))
    d.drain(d.exactly_once(d.dedup_stream(again, ["topic", "partition", "offset"]), lambda s: s, folder + "/out", folder + "/checkpoint"))
    out = spark.read.parquet(folder + "/out")
    assert out.count() == 1000 and out.select("offset").distinct().count() == 1000


def append_range(spark, path, begin, end):
    rows = spark.range(begin, end).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    source.with_log_columns(rows).write.mode("append").parquet(path)


def test_latest_starts_behind_the_end_once_and_for_all(spark, folder):
    path = write_records(spark, folder, 300, 100)
    stream = lambda: source.read_log_stream(spark, path, policy="latest", starts=folder + "/starts")
    first = stream()
    append_range(spark, path, 300, 310)
    d.drain(d.exactly_once(first, lambda s: s.select("offset"), folder + "/out", folder + "/checkpoint"))
    append_range(spark, path, 310, 350)  # while the query is down
    d.drain(d.exactly_once(stream(), lambda s: s.select("offset"), folder + "/out", folder + "/checkpoint"))
    assert sorted(r[0] for r in spark.read.parquet(folder + "/out").collect()) == list(range(300, 350))


def test_stream_starts_from_commits(spark, folder):
    path = write_records(spark, folder, 300, 100)
    commits = spark.createDataFrame([("a", "t", 0, 40, 1), ("a", "t", 0, 30, 2), ("b", "t", 0, 299, 1)], "group string, topic string, partition int, committed bigint, committed_at int")
    stream = source.read_log_stream(spark, path, policy="none", commits=commits, group="a", starts=folder + "/starts")
    d.drain(d.exactly_once(stream, lambda s: s.select("offset"), folder + "/out", folder + "/checkpoint"))
    assert sorted(r[0] for r in spark.read.parquet(folder + "/out").collect()) == list(range(30, 300))
    with pytest.raises(ValueError):
        source.read_log_stream(spark, path, commits=commits, starts=folder + "/other")
    with pytest.raises(Exception, match="no committed offset"):
        source.read_log_stream(spark, path, policy="none", starts=folder + "/none")


def test_at_most_once_skips_only_rows_that_were_started(spark, folder):
    path = write_records(spark, folder, 10, 10)
    run = lambda n: d.drain(d.deliver(source.read_log_stream(spark, path), d.append_effect(folder + "/effects"), d.AT_MOST_ONCE, f"{folder}/checkpoint{n}", started=folder + "/started"))
    run(1)
    append_range(spark, path, 10, 20)
    run(2)
    assert sorted(r["offset"] for r in spark.read.parquet(folder + "/effects").collect()) == list(range(20))


def test_transactions_take_all_rows_or_none(spark, folder):
    rows = spark.createDataFrame([(0, 1), (7, 2), (None, 3)], "partition int, id int")
    with pytest.raises(ValueError, match="partition"):
        sinks.atomic_append({"t": rows}, folder + "/log", folder + "/markers", "t1", "id", 3)
    assert not source.exists(spark, folder + "/log") and not source.exists(spark, folder + "/markers")


def test_progress_keeps_every_batch(spark, folder):
    write_records(spark, folder, 120, 1)
    recorder = progress.ProgressRecorder(spark, folder + "/progress", every=50)
    spark.streams.addListener(recorder)
    try:
        stream = spark.readStream.schema(source.LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
        query = d.drain(d.exactly_once(stream, lambda s: s, folder + "/out", folder + "/checkpoint"))
        recorder.wait_for_end(query)
    finally:
        spark.streams.removeListener(recorder)
    recorder.flush(spark, folder + "/progress")
    table = progress.progress_table(spark, folder + "/progress", query)
    assert table.agg(F.sum("input_rows")).first()[0] == 120 and table.filter("input_rows > 0").count() == 120


def test_progress_rows_and_cadence(spark, folder):
    path = write_records(spark, folder, 600, 100)
    recorder = progress.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        per_file = d.rate_limits("files", max_files=1)
        stream = spark.readStream.schema(source.LOG_SCHEMA).options(**per_file).parquet(path)
        query = d.drain(d.exactly_once(stream, lambda s: s, folder + "/out", folder + "/checkpoint"))
        assert spark.read.parquet(folder + "/out").count() == 600
        recorder.wait_for_end(query)
        assert recorder.flush(spark, folder + "/progress") >= 6
    finally:
        spark.streams.removeListener(recorder)
    table = progress.progress_table(spark, folder + "/progress", query).filter("input_rows > 0")
    assert [r["input_rows"] for r in table.orderBy("batch_id").collect()] == [100] * 6
    assert d.rate_limits("kafka", max_rows=10, min_rows=5, max_wait="1s") == {
        "maxOffsetsPerTrigger": "10", "minOffsetsPerTrigger": "5", "maxTriggerDelay": "1s"}


def test_retry_topics_with_timers(spark, folder):
    from tidelog.streaming.queries import _handle_script, wait_until_settled

    state.use_rocksdb(spark)
    keys = ["ok-1", "flaky2-2", "flaky9-3", "ok-4", "fatal-5", "poison-6"]
    for i, part in enumerate((keys[:2], keys[2:4], keys[4:])):
        spark.createDataFrame([(k, k) for k in part], "id string, payload string").coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = spark.readStream.schema("id string, payload string").option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    entries = state.retry_topics(stream, "t", _handle_script, failures.RetryPolicy(initial_ms=100, max_ms=400))
    query = entries.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/checkpoint").trigger(
        processingTime="300 milliseconds").start()
    try:
        wait_until_settled(query)
    finally:
        query.stop()
    rows = spark.read.parquet(folder + "/out").collect()
    by_key = {k: sorted((r["attempt"], r["via"]) for r in rows if r["id"] == k) for k in keys}
    assert sum(len(by_key[k]) for k in keys[:4]) == 10
    assert by_key["flaky9-3"] == [(1, "t"), (2, "t-retry-100"), (3, "t-retry-200"), (4, "t-dlt"), (4, "t-retry-400")]
    assert by_key["fatal-5"] == [(1, "t"), (1, "t-dlt")]
    assert by_key["poison-6"] == [(0, "t-dlt")]


def test_records_of_one_id_wait_side_by_side(spark, folder):
    from tidelog.streaming.queries import _handle_script, wait_until_settled

    state.use_rocksdb(spark)
    spark.createDataFrame([("same", "flaky9-1"), ("same", "flaky9-2"), ("same", "flaky1-3")], "id string, payload string").coalesce(1).write.parquet(folder + "/in")
    entries = state.retry_topics(spark.readStream.schema("id string, payload string").parquet(folder + "/in"), "t", _handle_script, failures.RetryPolicy(initial_ms=100, max_ms=400))
    query = entries.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/checkpoint").trigger(processingTime="200 milliseconds").start()
    try:
        wait_until_settled(query)
    finally:
        query.stop()
    counts = {r["payload"]: r["count"] for r in spark.read.parquet(folder + "/out").groupBy("payload").count().collect()}
    assert counts == {"flaky9-1": 5, "flaky9-2": 5, "flaky1-3": 2}


def test_settled_queue_records_leave_the_state(spark, folder):
    from tidelog.streaming.queries import wait_until_settled

    state.use_rocksdb(spark)
    rows = [(f"r{i}", 1, 0, 1000, queue.ACCEPT if i % 2 else queue.REJECT, i) for i in range(20)]
    spark.createDataFrame(rows, "id string, delivery int, delivered_us bigint, acked_us bigint, type string, seq bigint").coalesce(1).write.parquet(folder + "/in")
    acks = spark.readStream.schema("id string, delivery int, delivered_us bigint, acked_us bigint, type string, seq bigint").parquet(folder + "/in")
    updates = state.queue_state_stream(acks, 2, 2_000_000, forget_ms=500)
    query = updates.writeStream.outputMode("update").foreachBatch(d.append_effect(folder + "/states")).option("checkpointLocation", folder + "/checkpoint").trigger(processingTime="200 milliseconds").start()
    try:
        wait_until_settled(query)
    finally:
        query.stop()
    assert {r["state"] for r in state.latest_states(spark.read.parquet(folder + "/states")).collect()} == {"acknowledged", "archived"}
    assert spark.read.parquet(folder + "/states").count() == 20


def test_queue_state_stream_equals_batch(spark, folder):
    state.use_rocksdb(spark)
    rows = []
    for i in range(60):
        for n in range(1, 3):
            kind = {0: "REJECT", 1: "RELEASE", 2: "ACCEPT", 3: "ACCEPT"}[i % 4]
            if n == 2 and i % 4 in (0, 2):
                continue
            start = n * 10_000_000
            if i % 5 == 0:
                rows.append((i, n, start, start + 1_500_000, "RENEW", len(rows)))
            rows.append((i, n, start, start + (3_000_000 if i % 4 == 3 else 1_000_000) + (1_000_000 if i % 5 == 0 else 0), kind, len(rows)))
    schema = "id int, delivery int, delivered_us long, acked_us long, type string, seq long"
    for lo in range(0, len(rows), 40):
        spark.createDataFrame(rows[lo:lo + 40], schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        for name in os.listdir(folder + "/in"):
            full = os.path.join(folder + "/in", name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 1_750_000_000:
                os.utime(full, (1_700_000_000 + lo, 1_700_000_000 + lo))
    acks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    updates = state.queue_state_stream(acks.withColumn("id", F.col("id").cast("string")), limit=2, lock_us=2_000_000)
    d.drain(updates.writeStream.outputMode("update").foreachBatch(d.append_effect(folder + "/states")).option("checkpointLocation", folder + "/checkpoint"))
    streamed = {int(r["id"]): tuple(r)[1:] for r in state.latest_states(spark.read.parquet(folder + "/states")).collect()}
    batch = queue.queue_state(spark.read.schema(schema).parquet(folder + "/in"), ["id"], "seq", limit=2, lock_us=2_000_000, chunk_rows=7)
    assert streamed == {r["id"]: tuple(r)[1:] for r in batch.collect()}


def test_paced_stream(spark, folder):
    stream = generate.paced_stream(spark, 50, size=100)
    query = stream.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/checkpoint").trigger(
        processingTime="500 milliseconds").start()
    import time
    deadline = time.time() + 30
    while time.time() < deadline and sum(p.numInputRows for p in query.recentProgress) < 50:
        time.sleep(0.3)
    query.stop()
    rows = spark.read.parquet(folder + "/out")
    assert rows.count() >= 50
    assert rows.filter(~F.col("key").startswith("customer-")).count() == 0


def test_top_up_writes_only_what_is_missing(spark, folder):
    path = folder + "/log"
    assert generate.top_up(spark, path, "seed", 3, 100, size=100) == 100
    assert generate.top_up(spark, path, "seed", 3, 60, size=100) == 100
    assert generate.top_up(spark, path, "seed", 3, 130, size=100) == 130
    log = source.read_log(spark, path, "seed")
    ends = log.groupBy("partition").agg(F.max("offset").alias("m"), F.count("*").alias("n"), F.countDistinct("offset").alias("d")).collect()
    assert all(r["m"] + 1 == r["n"] == r["d"] for r in ends)


def test_idle_sessions(spark, folder):
    rows = spark.createDataFrame([("t", 0, s) for s in (0, 1, 2, 100, 101, 1000, 5000)], "topic string, partition int, s long")
    rows.select("topic", "partition", F.timestamp_seconds("s").alias("timestamp")).coalesce(1).write.parquet(folder + "/in")
    stream = spark.readStream.schema("topic string, partition int, timestamp timestamp").parquet(folder + "/in")
    d.drain(d.exactly_once(d.idle_sessions(stream, "10 seconds", "1 second"), lambda s: s, folder + "/out", folder + "/checkpoint"))
    got = sorted(r["records"] for r in spark.read.parquet(folder + "/out").collect())
    assert got == [1, 2, 3]


def test_append_stream_hides_an_attempt_that_died(spark, folder, monkeypatch):
    from tidelog.operators import visibility
    from tidelog.sources import sinks

    path = write_records(spark, folder, 300, 100)
    log, markers = folder + "/log", folder + "/markers"
    real = d.write_marker

    def dies_once(session, where, txn_id, outcome, epoch=0):
        if outcome == "commit" and "-1-" in txn_id and not os.path.exists(folder + "/died"):
            os.mkdir(folder + "/died")
            raise Crash("after the rows, before the marker")
        real(session, where, txn_id, outcome, epoch)

    monkeypatch.setattr(d, "write_marker", dies_once)
    writer = lambda: d.append_log_stream(
        source.read_log_stream(spark, path, files_per_trigger=1).select("topic", "partition", "timestamp", "key", "value", F.col("offset").alias("seq")),
        log, markers, "copy", "seq", 1, folder + "/checkpoint")
    with pytest.raises(StreamingQueryException):
        d.drain(writer())
    d.drain(writer())
    everything = source.read_log(spark, log)
    seen = visibility.read_committed(everything, sinks.read_markers(spark, markers))
    assert everything.count() == 400
    assert seen.count() == 300 and seen.select("key").distinct().count() == 300
    assert everything.select("offset").distinct().count() == 400


def test_bounded_dedup_forgets_what_is_later_than_its_delay(spark, folder):
    rows = [(i, 1_000_000 + i * 60) for i in range(10)] + [(0, 1_000_003)]
    for i, (id_, s) in enumerate(rows):
        spark.createDataFrame([(id_, s)], "id long, s long").coalesce(1).write.mode("append").parquet(folder + "/in")
        for name in os.listdir(folder + "/in"):
            full = os.path.join(folder + "/in", name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 1_750_000_000:
                os.utime(full, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    stream = spark.readStream.schema("id long, s long").option("maxFilesPerTrigger", 1).parquet(folder + "/in").withColumn("at", F.timestamp_seconds("s"))
    d.drain(d.exactly_once(d.dedup_stream(stream, ["id"], "at", "30 seconds"), lambda x: x, folder + "/out", folder + "/checkpoint"))
    assert sorted(r["id"] for r in spark.read.parquet(folder + "/out").collect()) == list(range(10))


def test_commits_hold_400_records_however_long_the_log(spark, monkeypatch, folder):
    from tidelog import workloads
    from tidelog.streaming import deliver, queries

    asked = []
    each = deliver.commit_every_n
    monkeypatch.setattr(queries.d, "commit_every_n", lambda s, path, n: asked.append(n) or each(s, path, n))
    monkeypatch.setattr(workloads, "events", lambda s, sf: s.range(9000).selectExpr("id event_id", "timestamp_seconds(id) ts"))
    assert tuple(queries.stream_commit_every_n(spark, folder).first()) == (9000, 8999, True)
    assert asked == [400]


class CountedMap:
    """A map state in memory that counts the messages it would send."""

    def __init__(self, handle):
        self.handle, self.held = handle, {}

    def _told(self, result=None):
        self.handle.calls += 1
        return result

    def containsKey(self, key):
        return self._told(key in self.held)

    def getValue(self, key):
        return self._told(self.held.get(key))

    def updateValue(self, key, value):
        self._told(self.held.update({key: value}))

    def removeKey(self, key):
        self._told(self.held.pop(key, None))

    def keys(self):
        return self._told(iter(list(self.held)))


class CountedHandle:
    def __init__(self, now=0):
        self.calls, self.timers, self.now = 0, set(), now

    def getMapState(self, name, key, value):
        return CountedMap(self)

    def registerTimer(self, due):
        self.calls += 1
        self.timers.add(due)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return min(self.timers)


def test_waiting_records_share_state_entries(spark):
    import pandas as pd

    from tidelog.streaming.queries import _handle_script

    handle = CountedHandle()
    processor = state.RetryProcessor("t", _handle_script, failures.RetryPolicy(initial_ms=100, max_ms=400))
    processor.init(handle)
    # One hot id among others: 6000 records that fail for good.
    frame = pd.DataFrame({"id": ["hot"] * 3000 + [f"i{n}" for n in range(3000)], "payload": [f"flaky9-{n}" for n in range(6000)]})
    out = list(processor.handleInputRows((0,), iter([frame]), handle))
    while handle.timers:
        handle.now = handle.getExpiryTimeInMs()
        due = CountedHandle()
        due.timers = {handle.now}
        out += processor.handleExpiredTimer((0,), handle, due)
        handle.timers.discard(handle.now)
    rows = pd.concat(out)
    assert len(rows) == 5 * 6000 and rows.groupby("payload").attempt.max().eq(4).all() and rows.via.value_counts()["t-dlt"] == 6000
    assert not processor.waiting.held and handle.calls < 150


def test_queue_states_share_state_entries(spark):
    import pandas as pd

    handle = CountedHandle()
    processor = state.QueueProcessor(2, 2_000_000, forget_ms=500)
    processor.init(handle)
    acks = lambda n, kind: pd.DataFrame({"id": [f"i{i}" for i in range(5000)], "delivery": n, "delivered_us": n * 10_000_000, "acked_us": n * 10_000_000 + 1, "type": kind, "seq": range(5000)})
    first = pd.concat(list(processor.handleInputRows((0,), iter([acks(1, queue.RELEASE)]), handle)))
    second = pd.concat(list(processor.handleInputRows((0,), iter([acks(2, queue.ACCEPT)]), handle)))
    assert set(first.state) == {"available"} and set(second.state) == {"acknowledged"} and len(second) == 5000
    assert second.applied.eq(2).all() and second.deliveries.eq(2).all()
    list(processor.handleExpiredTimer((0,), handle, handle))
    assert not processor.records.held and not processor.settled.held and handle.calls < 50


def test_commits_within_a_batch_outlive_a_crash(spark, folder):
    from tidelog.streaming.source import drain_log

    path, out = folder + "/log", folder + "/effects"
    rows = spark.range(5050).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.timestamp_seconds("id").alias("timestamp"), "id",
                                    F.col("id").cast("string").cast("binary").alias("value"))
    source.append_log(rows, path, "id", 1)
    failing = lambda df: df.withColumn("ok", F.when(F.col("offset") == 1234, F.raise_error(F.lit("crash")).cast("int")).otherwise(1))
    run = lambda change: drain_log(d.deliver(d.commit_every_n(spark, path, 10), d.append_effect(out, change, commit_rows=10), d.AT_LEAST_ONCE, folder + "/checkpoint"), path)
    with pytest.raises(StreamingQueryException):
        run(failing)
    before = {r["commit"]: r["n"] for r in spark.read.parquet(out).groupBy("commit").agg(F.count("*").alias("n")).collect()}
    assert before and set(before.values()) == {10} and "t-0-1230-1239" not in before
    run(lambda df: df.withColumn("ok", F.lit(2)))
    done = spark.read.parquet(out)
    assert done.count() == 5050 and done.select("offset").distinct().count() == 5050
    # Tasks of the batch that failed may end a commit after it.
    first = done.filter("ok = 1")
    assert before.keys() <= {r["commit"] for r in first.select("commit").distinct().collect()} and first.count() < 5050
    assert done.groupBy("commit").count().filter("count > 10").isEmpty() and done.select("commit").distinct().count() == 505
    assert done.select("batch_id").distinct().count() == 1

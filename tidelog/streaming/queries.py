"""Registered queries that run a stream over the given tables until it is drained."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import workloads as w
from tidelog.functions import keys as fk
from tidelog.operators import failures, queue, records, visibility
from tidelog.queries import query
from tidelog.session import shared_folder
from tidelog.sources import log as source
from tidelog.sources import segments, sinks
from tidelog.sources.segments import LogIndex
from tidelog.streaming import deliver as d
from tidelog.streaming import progress, state, worker
from tidelog.streaming.source import drain_log, log_lag, log_stream


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files. The pattern fits one file as well as a folder of files."""
    path = f"{sf_dir}/events*.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_exactly_once(spark, sf):
    folder = shared_folder(spark)
    upper = lambda s: s.select("event_id", F.upper("event_type").alias("value"))
    d.drain(d.exactly_once(events_stream(spark, sf), upper, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out")


@query
def stream_append_log(spark, sf):
    """The stream lands in a log table with dense offsets, one transaction per micro-batch."""
    folder = shared_folder(spark)
    rows = events_stream(spark, sf).select(
        F.lit("events").alias("topic"), fk.key_partition(w.user_key(), w.PARTITIONS).alias("partition"),
        F.col("ts").alias("timestamp"), w.user_key().alias("key"), w.event_value().alias("value"), "event_id")
    d.drain(d.append_log_stream(rows, f"{folder}/log", f"{folder}/markers", "events", "event_id", w.PARTITIONS, f"{folder}/checkpoint"))
    visible = visibility.read_committed(source.read_log(spark, f"{folder}/log"), sinks.read_markers(spark, f"{folder}/markers"))
    return visible.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("offset").alias("offsets"), (F.max("offset") + 1).alias("end"))


@query
def stream_append_rejects(spark, sf):
    """Every row of a stream is in the log or in the table of rejects, with the reason."""
    folder = shared_folder(spark)
    partition = F.when(F.col("event_id") % 17 == 0, None).when(F.col("event_id") % 19 == 0, 99).otherwise(fk.key_partition(w.user_key(), w.PARTITIONS))
    rows = events_stream(spark, sf).select(
        F.lit("events").alias("topic"), partition.alias("partition"), F.col("ts").alias("timestamp"), w.user_key().alias("key"),
        F.col("event_id").cast("string").cast("binary").alias("value"), "event_id")
    d.drain(d.append_log_stream(rows, f"{folder}/log", f"{folder}/markers", "events", "event_id", w.PARTITIONS, f"{folder}/checkpoint"))
    placed = visibility.read_committed(source.read_log(spark, f"{folder}/log"), sinks.read_markers(spark, f"{folder}/markers"))
    rejected = spark.read.parquet(f"{folder}/log-rejects")
    return placed.select(F.col("value").cast("string").cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("event_id", "reason"))


@query
def stream_read_log(spark, sf):
    """A written log read as a stream, from the earliest offset."""
    folder = shared_folder(spark)
    log = source.with_log_columns(w.log6(spark, sf, value=F.col("event_type")))
    log.write.partitionBy("topic", "partition").parquet(f"{folder}/log")
    stream = source.read_log_stream(spark, f"{folder}/log", "events", files_per_trigger=1000)
    d.drain(d.exactly_once(stream, lambda s: s.select("partition", "offset", F.col("value").cast("string").alias("value")),
                           f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out")


def _events_log(spark, sf, path, partitions=1, **more):
    """Events appended to a log with a segment index, in files of any size."""
    partition = F.lit(0) if partitions == 1 else (F.col("event_id") % partitions).cast("int")
    rows = w.events(spark, sf).select(F.lit("events").alias("topic"), partition.alias("partition"), F.col("ts").alias("timestamp"), "event_id",
                                      F.col("event_id").cast("string").cast("binary").alias("value"))
    source.append_log(rows, path, "event_id", partitions, chunk_rows=w.QUERY_CHUNK, **more)


@query
def stream_commit_every_n(spark, sf):
    """A log read with a commit after every 400 records at most: what the last commit covers, and that none held more."""
    folder, n = shared_folder(spark), 400
    _events_log(spark, sf, f"{folder}/log")
    stream = d.commit_every_n(spark, f"{folder}/log", n)
    drain_log(d.deliver(stream, d.append_effect(f"{folder}/effects", commit_rows=n), d.AT_LEAST_ONCE, f"{folder}/checkpoint"), f"{folder}/log")
    commits = spark.read.parquet(f"{folder}/effects").groupBy("commit").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last"))
    return commits.agg(F.sum("n").alias("records"), F.max("last").alias("last_seen"), (F.max("n") <= n).alias("bounded"))


@query
def stream_row_limits(spark, sf):
    """A log of six partitions read in micro-batches of a ninth of its records: what each took, and what it left."""
    folder = shared_folder(spark)
    path = f"{folder}/log"
    _events_log(spark, sf, path, w.PARTITIONS)
    most = -(-sum(LogIndex(path).state().ends.values()) // 9)
    recorder = progress.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        stream = log_stream(spark, path, "events", max_rows=most, min_rows=1, max_wait_s=1)
        running = drain_log(d.deliver(stream, d.append_effect(f"{folder}/out"), d.AT_LEAST_ONCE, f"{folder}/checkpoint"), path, "events")
        recorder.wait_for_end(running)
    finally:
        spark.streams.removeListener(recorder)
    recorder.flush(spark, f"{folder}/progress")
    told = progress.progress_table(spark, f"{folder}/progress", running).filter("input_rows > 0")
    left = log_lag(spark, path, told).groupBy("batch_id").agg(F.sum("lag").alias("lag"))
    read = spark.read.parquet(f"{folder}/out").groupBy("batch_id").agg(F.count(F.lit(1)).alias("records"))
    return read.join(left, "batch_id").join(told.select("batch_id", "input_rows"), "batch_id").select("batch_id", "records", "input_rows", "lag")


@query
def stream_paced(spark, sf):
    """A log read at a steady rate that two seconds suffice for: every record once, none before its time."""
    folder = shared_folder(spark)
    path = f"{folder}/log"
    _events_log(spark, sf, path, w.PARTITIONS)
    total = sum(LogIndex(path).state().ends.values())
    began = time.monotonic()
    stream = log_stream(spark, path, rows_per_second=max(1, total / 2))
    drain_log(d.deliver(stream, d.append_effect(f"{folder}/out"), d.AT_LEAST_ONCE, f"{folder}/checkpoint"), path)
    paced = time.monotonic() - began >= 2
    rows = spark.read.parquet(f"{folder}/out")
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_distinct(F.col("value").cast("string")).alias("events"), F.lit(paced).alias("paced"))


@query
def stream_append_segments(spark, sf):
    """A stream appended to a log, each micro-batch in one step, read again by its index."""
    folder = shared_folder(spark)
    path = f"{folder}/log"
    partition = F.when(F.col("event_id") % 17 == 0, None).otherwise(fk.key_partition(w.user_key(), w.PARTITIONS))
    rows = events_stream(spark, sf).select(F.lit("events").alias("topic"), partition.alias("partition"), F.col("ts").alias("timestamp"), w.user_key().alias("key"), "event_id")
    d.drain(d.append_segments_stream(rows, path, "events", "event_id", w.PARTITIONS, f"{folder}/checkpoint"))
    refused = spark.read.parquet(f"{path}-rejects").join(segments.index_markers(spark, path), "txn_id").groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    held = segments.index_bounds(spark, path).select("topic", "partition", "begin", "end", "records", F.lit(None).cast("string").alias("reason"))
    return held.unionByName(refused, allowMissingColumns=True)


@query
def stream_rate_limits(spark, sf):
    """Twelve files at five per micro-batch: rows read and batches taken."""
    folder = shared_folder(spark)
    w.events(spark, sf).select("event_id").repartitionByRange(12, "event_id").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("event_id bigint").options(**d.rate_limits("files", max_files=5)).parquet(f"{folder}/in")
    d.drain(d.deliver(stream, d.append_effect(f"{folder}/out"), d.AT_LEAST_ONCE, f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("batch_id").alias("batches"))


@query
def stream_dedup(spark, sf):
    """Every 13th record is delivered twice."""
    folder = shared_folder(spark)
    stream = events_stream(spark, sf).select("event_id", "user_id")
    twice = stream.unionByName(stream.filter(F.col("event_id") % 13 == 0))
    d.drain(d.exactly_once(d.dedup_stream(twice, ["event_id"]), lambda s: s, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out")


def _delivered_twice_over(spark, sf, mode):
    """The same log drained twice with a lost checkpoint in between: how often each record took effect."""
    folder = shared_folder(spark)
    log = source.with_log_columns(w.log6(spark, sf, value=F.col("event_id").cast("string")))
    log.write.partitionBy("topic", "partition").parquet(f"{folder}/log")
    stream = source.read_log_stream(spark, f"{folder}/log", "events").select(
        "topic", "partition", "offset", F.col("value").cast("string").cast("bigint").alias("event_id"))
    for run in ("first", "second"):
        d.drain(d.deliver(stream, d.append_effect(f"{folder}/effects"), mode, f"{folder}/checkpoint-{run}",
                          started=f"{folder}/started", ledger=d.effect_ledger(f"{folder}/effects")))
    return spark.read.parquet(f"{folder}/effects").groupBy("event_id").agg(F.count(F.lit(1)).alias("effects"))


@query
def stream_at_least_once(spark, sf):
    return _delivered_twice_over(spark, sf, d.AT_LEAST_ONCE)


@query
def stream_at_most_once(spark, sf):
    return _delivered_twice_over(spark, sf, d.AT_MOST_ONCE)


@query
def stream_effectively_once(spark, sf):
    return _delivered_twice_over(spark, sf, d.EFFECTIVELY_ONCE)


@query
def stream_retry_entries(spark, sf):
    """Retry-topic deliveries of a stream: the attempts are worked out per record, without state."""
    folder = shared_folder(spark)
    log = records.parse_plan(events_stream(spark, sf).select(F.lit("orders").alias("topic"), "event_id", w.retry_key().alias("key")))
    policy = failures.RetryPolicy(initial_ms=1000, max_ms=10_000)
    entries = failures.retry_topic_entries(log, failures.scripted_handler, policy).select("event_id", "attempt", "error", "due_ms", "via")
    d.drain(d.exactly_once(entries, lambda s: s, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.parquet(f"{folder}/out")


def _handle_script(id_: str, payload: str, attempt: int) -> str | None:
    if payload.startswith("poison"):
        return failures.UNDECODABLE
    if payload.startswith("fatal"):
        return failures.FATAL
    if payload.startswith("flaky"):
        return failures.TRANSIENT if attempt <= int(payload[len("flaky"):payload.index("-")]) else None
    return None


@query
def stream_retry_topics(spark, sf):
    """The same deliveries by keyed state and timers: failed records really wait and come back."""
    state.use_rocksdb(spark)
    folder = shared_folder(spark)
    stream = events_stream(spark, sf).select(F.col("event_id").cast("string").alias("id"), w.retry_key().alias("payload"))
    policy = failures.RetryPolicy(initial_ms=1000, max_ms=10_000)
    entries = state.retry_topics(stream, "orders", _handle_script, policy)
    running = entries.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="500 milliseconds").start()
    try:
        wait_until_settled(running)
    finally:
        running.stop()
    return spark.read.parquet(f"{folder}/out").select(F.col("id").cast("bigint").alias("event_id"), "attempt", "error", "via")


def wait_until_settled(running) -> None:
    """Until the stream has taken its input and no record waits in its state: then no timer is left either."""
    while True:
        if running.exception() is not None:
            raise running.exception()
        told = [json.loads(p.json) for p in running.recentProgress]
        started = any(p["numInputRows"] > 0 for p in told)
        waiting = sum(o.get("numRowsTotal", 0) for o in told[-1].get("stateOperators", [])) if told else None
        if started and told[-1]["numInputRows"] == 0 and waiting == 0:
            return
        time.sleep(0.2)


@query
def stream_queue_state(spark, sf):
    state.use_rocksdb(spark)
    folder = shared_folder(spark)
    rows = events_stream(spark, sf).select("event_id", F.unix_micros("ts").alias("ts_us"))
    acked = queue.queue_worker(rows, lambda n: queue.scripted_decision("explicit", F.col("event_id"), n), limit=5)
    took = F.when(F.col("event_id") % 20 == 0, 3_000_000).otherwise(1_000_000)
    delivered = F.col("ts_us") + (F.col("delivery") - 1) * 10_000_000
    acks = acked.select(F.col("event_id").cast("string").alias("id"), "delivery", delivered.alias("delivered_us"),
                        (delivered + took).alias("acked_us"), "type", (F.col("event_id") * 8 + F.col("delivery")).alias("seq"))
    updates = state.queue_state_stream(acks, limit=2, lock_us=2_000_000)
    d.drain(updates.writeStream.outputMode("update").foreachBatch(d.append_effect(f"{folder}/states")).option(
        "checkpointLocation", f"{folder}/checkpoint"))
    return state.latest_states(spark.read.parquet(f"{folder}/states")).withColumn("event_id", F.col("id").cast("bigint")).drop("id")


@query
def stream_queue_worker(spark, sf):
    """The explicit script over a log read in four micro-batches; every 20th record's first answer comes after its lock."""
    folder = shared_folder(spark)
    path = f"{folder}/log"
    _events_log(spark, sf, path, w.PARTITIONS)
    most = -(-sum(LogIndex(path).state().ends.values()) // 4)
    records = log_stream(spark, path, max_rows=most).select(F.col("value").cast("string").cast("bigint").alias("event_id"))
    work = worker.by_decision(
        lambda n: queue.scripted_decision("explicit", F.col("event_id"), n),
        lambda n: F.when((F.col("event_id") % 20 == 0) & (n == 1), 3_000_000).otherwise(1_000_000))
    drain_log(worker.queue_worker_stream(records, f"{folder}/work", work, 5, f"{folder}/checkpoint", lock_us=2_000_000), path)
    return worker.read_acks(spark, f"{folder}/work").select("event_id", "delivery", "type", "applied")


@query
def stream_progress(spark, sf):
    """Rows that went through a query, from its own progress reports."""
    folder = shared_folder(spark)
    tapped, _ = records.tap(events_stream(spark, sf), "seen", errors=F.count_if(F.col("event_type") == "error"))
    recorder = progress.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        running = d.drain(d.exactly_once(tapped.select("event_id"), lambda s: s, f"{folder}/out", f"{folder}/checkpoint"))
        recorder.wait_for_end(running)
    finally:
        spark.streams.removeListener(recorder)
    recorder.flush(spark, f"{folder}/progress")
    table = progress.progress_table(spark, f"{folder}/progress", running)
    errors = F.get_json_object("observed", "$.seen.errors").cast("bigint")
    return table.agg(F.sum("input_rows").alias("input_rows"), F.sum(errors).alias("errors"))

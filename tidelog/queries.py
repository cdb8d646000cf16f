"""The registered queries: each operator over whole given tables, or over what Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import workloads as w
from tidelog.functions import headers as hdr
from tidelog.functions import keys as fk
from tidelog.functions import orders as fo
from tidelog.plans import scans
from tidelog.plans.once import materialised
from tidelog.operators import (
    audit, failures, handlers, ledger, partitioning, progress, queue, records, runs, schemas, timelines, visibility)
from tidelog.session import shared_folder
from tidelog.sources import generate, log as source, segments, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _ts_us() -> F.Column:
    return F.unix_micros("timestamp").alias("ts_us")


# ---- sources and sinks ------------------------------------------------------------------------------------------

@query
def as_log(spark, sf):
    return w.log6(spark, sf).select("topic", "partition", "offset", "key", "event_id", _ts_us())


def _rows_to_append(spark, sf):
    return w.events(spark, sf).select(
        F.lit("events").alias("topic"), fk.key_partition(w.user_key(), w.PARTITIONS).alias("partition"),
        F.col("ts").alias("timestamp"), w.user_key().alias("key"), w.event_value().alias("value"), "event_id")


@query
def append_then_read_log(spark, sf):
    """Two appends, the second continuing the offsets of the first, then a read of the written table."""
    path = shared_folder(spark)
    rows = _rows_to_append(spark, sf)
    half = F.lit("2024-01-16").cast("timestamp")
    source.append_log(rows.filter(F.col("timestamp") < half), path, "event_id", w.PARTITIONS, chunk_rows=w.QUERY_CHUNK)
    source.append_log(rows.filter(F.col("timestamp") >= half), path, "event_id", w.PARTITIONS, chunk_rows=w.QUERY_CHUNK)
    return source.read_log(spark, path, "events").select(
        "topic", "partition", "offset", "key", F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint").alias("event_id"))


def _indexed(spark, sf):
    """The events as a log written in four appends."""
    path = shared_folder(spark)
    rows = _rows_to_append(spark, sf)
    for quarter in range(4):
        source.append_log(rows.filter(F.floor(F.dayofmonth("timestamp") / 8) == quarter), path, "event_id", w.PARTITIONS, chunk_rows=w.QUERY_CHUNK)
    return path


@query
def log_index(spark, sf):
    """What the index of a log tells of its partitions, without opening a segment."""
    index = segments.log_index(spark, _indexed(spark, sf))
    return index.groupBy("topic", "partition").agg(
        F.min("base").alias("begin"), F.max("end").alias("end"), F.sum("records").alias("records"), F.unix_micros(F.min("least")).alias("first_us"),
        F.unix_micros(F.max("greatest")).alias("last_us"), F.count_distinct("version").alias("appends"))


@query
def seek_by_index(spark, sf):
    """A replay from a time and the last 100 of each partition, from the segments that hold them alone."""
    path = _indexed(spark, sf)
    late = segments.replay_by_index(spark, path, source.LOG_SCHEMA, from_time=F.lit("2024-01-15 12:00:00").cast("timestamp"))
    last = segments.replay_by_index(spark, path, source.LOG_SCHEMA, last=100)
    each = lambda df, name: df.select(F.lit(name).alias("replay"), "partition", "offset", F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint").alias("event_id"))
    return each(late, "time").unionByName(each(last, "last"))


@query
def append_reports_unplaceable(spark, sf):
    """Rows that cannot be appended come back with a reason."""
    rows = _rows_to_append(spark, sf).withColumn(
        "partition", F.when(F.col("event_id") % 17 == 0, None).when(F.col("event_id") % 19 == 0, 99).otherwise(F.col("partition")))
    rejected = source.append_log(rows, shared_folder(spark), "event_id", w.PARTITIONS, chunk_rows=w.QUERY_CHUNK)
    return rejected.select("event_id", "reason")


@query
def read_assigned(spark, sf):
    return source.read_assigned(w.log6(spark, sf), {0: 100, 1: 500, 3: 0}).select("partition", "offset", "event_id")


def _start(spark, sf, policy):
    log = w.log6(spark, sf)
    return source.start_policy(progress.bounds(log), w.commits(log), policy, group="g").select("topic", "partition", "committed", "start")


@query
def start_policy_earliest(spark, sf):
    return _start(spark, sf, "earliest")


@query
def start_policy_latest(spark, sf):
    return _start(spark, sf, "latest")


@query
def start_policy_none(spark, sf):
    """Every partition has a commit, so the strict policy has nothing to object to."""
    log = w.log6(spark, sf)
    bounds = progress.bounds(log)
    committed = bounds.select("topic", "partition", F.floor(F.col("end") / 2).cast("bigint").alias("committed"))
    return source.start_policy(bounds, committed, "none").select("topic", "partition", "committed", "start")


@query
def with_headers(spark, sf):
    log = w.log6(spark, sf, keep=("event_id", "event_type"))
    sent = hdr.with_headers(log, {"type": F.col("event_type"), "trace": F.col("event_id").cast("string"), "topic": "routed"})
    again = hdr.with_headers(sent, {"type": F.upper("event_type")})
    return again.select("topic", "event_id", F.size("headers").alias("n_headers"),
                        hdr.header_text(F.col("headers"), "type").alias("type_header"),
                        hdr.header_text(F.col("headers"), "trace").alias("trace_header"),
                        hdr.header_text(F.col("headers"), "none").alias("absent_header"))


@query
def stamp_sent_at(spark, sf):
    stamped = hdr.stamp_sent_at(w.log6(spark, sf), F.col("timestamp"))
    return stamped.select("event_id", hdr.header_text(F.col("headers"), hdr.SENT_AT).alias("sent_at"))


@query
def top_up(spark, sf):
    """A log topped up in two steps to as many rows as there are events."""
    path, total = shared_folder(spark), w.table(spark, sf, "events").count()
    ids = w.table(spark, sf, "events").select(F.col("event_id").alias("id"))
    generate.top_up(spark, path, "seed", w.PARTITIONS, total // 3, size=200, ids=ids)
    generate.top_up(spark, path, "seed", w.PARTITIONS, total, size=200, ids=ids)
    return progress.bounds(source.read_log(spark, path, "seed"))


@query
def gen_orders(spark, sf):
    ids = w.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return generate.gen_orders(ids, "o_orderkey", F.col("o_orderdate").cast("timestamp")).select(
        "seq", "orderId", "customerId", F.col("totalAmount").cast("string").alias("totalAmount"), "currency",
        F.unix_micros("createdAt").alias("created_us"))


@query
def gen_payload(spark, sf):
    return generate.gen_payload(w.table(spark, sf, "events"), "event_id", 512, 100)


@query
def gen_random(spark, sf):
    return generate.gen_random(w.table(spark, sf, "events"), "event_id", 100, 100)


@query
def codec_report(spark, sf):
    """Rows read back under each codec, and whether its files are smaller than the plain ones."""
    report = sinks.codec_report(w.table(spark, sf, "lineitem"), shared_folder(spark))
    return report.select("codec", "records", (F.col("rate") < 1).alias("smaller"))


@query
def write_by_type(spark, sf):
    rows = w.orders_rows(spark, sf).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "bytes").otherwise("order").alias("kind"),
        F.lit("{not json").cast("binary").alias("raw"),
        F.struct(F.col("order.orderId").alias("orderId"), F.col("order.currency").alias("currency")).alias("typed"))
    return sinks.write_by_type(rows, "kind", "raw", {"order": "typed"}).select(
        "o_orderkey", "kind", F.col("value").cast("string").alias("value"))


@query
def atomic_append(spark, sf):
    """Two topics in a committed transaction, one in an aborted one, one left open; what each isolation sees."""
    base = shared_folder(spark)
    path, marks = f"{base}/log", f"{base}/markers"
    rows = w.events(spark, sf).select(
        fk.key_partition(w.user_key(), w.PARTITIONS).alias("partition"), F.col("ts").alias("timestamp"),
        w.user_key().alias("key"), w.event_value().alias("value"), "event_id", "event_type")
    of = lambda kind: rows.filter(F.col("event_type") == kind).drop("event_type")
    sinks.atomic_append({"clicks": of("click"), "views": of("view")}, path, marks, "t1", "event_id", w.PARTITIONS)
    sinks.atomic_append({"clicks": of("error")}, path, marks, "t2", "event_id", w.PARTITIONS, outcome="abort")
    sinks.atomic_append({"purchases": of("purchase")}, path, marks, "t4", "event_id", w.PARTITIONS)
    source.append_log(of("signup").withColumn("topic", F.lit("signups")), path, "event_id", w.PARTITIONS, txn_id="t3")
    everything = source.read_log(spark, path)
    visible = visibility.read_committed(everything, sinks.read_markers(spark, marks))
    count = lambda df, name: df.groupBy("topic").agg(F.count(F.lit(1)).alias("records")).withColumn("isolation", F.lit(name))
    return count(everything, "read_uncommitted").unionByName(count(visible, "read_committed"))


# ---- projections and filters ------------------------------------------------------------------------------------

@query
def map_value(spark, sf):
    log = w.log6(spark, sf, value=F.col("event_type"))
    return records.map_value(log, F.upper("value")).select("partition", "offset", "key", "value")


@query
def filter_records(spark, sf):
    """Delivered records, and the progress that also covers what was dropped."""
    log = w.log6(spark, sf)
    kept = records.filter_records(log, F.col("offset") % 2 == 0).groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("delivered"))
    return kept.join(progress.next_offsets(log), ["topic", "partition"])


@query
def filter_report(spark, sf):
    return records.filter_report(w.log6(spark, sf), F.col("offset") % 2 == 0, ["topic", "partition"])


@query
def record_id(spark, sf):
    return w.log6(spark, sf).select("event_id", records.record_id().alias("id"), records.record_id(True).alias("full_id"))


@query
def key_parts(spark, sf):
    return records.key_parts(w.log6(spark, sf, key=w.vip_key())).select("event_id", "key", "family", "number")


@query
def parse_plan(spark, sf):
    key = F.when(F.col("event_id") % 97 == 0, w.user_key()).when(F.col("event_id") % 89 == 0, None).otherwise(w.retry_key())
    return records.parse_plan(w.events(spark, sf).select("event_id", key.alias("key"))).select(
        "event_id", "key", "kind", "failures", "plan_error")


@query
def narrow(spark, sf):
    return records.narrow(w.orders_json(spark, sf), fo.ORDER_VIEW_SCHEMA).select(
        "o_orderkey", F.col("view.orderId").alias("orderId"), F.col("view.totalAmount").cast("string").alias("totalAmount"))


# ---- partitioning and skew --------------------------------------------------------------------------------------

@query
def key_partition(spark, sf):
    name = F.col("c_name")
    return w.table(spark, sf, "customer").select(
        "c_custkey", fk.murmur2_signed(name).alias("hash"), fk.key_partition(name, 6).alias("p6"), fk.key_partition(name, 100).alias("p100"))


@query
def tenant_partition(spark, sf):
    key = F.when(F.col("event_id") % 7 == 0, None).otherwise(w.vip_key())
    rows = w.events(spark, sf).select(F.lit("tenants").alias("topic"), key.alias("key"), "event_id")
    return partitioning.assign_tenants(rows, 6, "event_id", w.QUERY_CHUNK).select("event_id", "key", "partition")


@query
def round_robin_partition(spark, sf):
    rows = w.events(spark, sf).select(F.lit("even").alias("topic"), w.user_key().alias("key"), "event_id")
    return partitioning.ignore_keys(rows, 6, "event_id", w.QUERY_CHUNK).select("event_id", "partition")


@query
def salted_totals(spark, sf):
    """Hot customers salted over 8 shards, aggregated in two stages."""
    rows = w.events(spark, sf).select(w.user_key().alias("key"), "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    hot = F.col("key").isin("customer-0", "customer-7")
    salted = partitioning.salt_hot_keys(rows, hot, F.col("event_id"), 8)
    return partitioning.salted_totals(salted, F.col("cents")).select("base_key", "records", "total")


@query
def partition_spread(spark, sf):
    return partitioning.partition_spread(w.log6(spark, sf))


@query
def moved_keys(spark, sf):
    """Keys change partition when the partition count does: the first half of the month has 6, the rest 4."""
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    rows = w.events(spark, sf).select(w.user_key().alias("key"), F.when(early, fk.key_partition(w.user_key(), 6)).otherwise(
        fk.key_partition(w.user_key(), 4)).alias("partition"))
    return partitioning.moved_keys(rows)


@query
def moved_keys_report(spark, sf):
    return partitioning.moved_keys_report(w.log6(spark, sf))


@query
def hot_keys(spark, sf):
    return partitioning.hot_keys(w.log6(spark, sf), 5)


# ---- joins and visibility ---------------------------------------------------------------------------------------

def _seen_dup(log):
    return log.unionByName(log.filter(F.col("event_id") % 13 == 0))


@query
def skip_handled(spark, sf):
    log = w.log6(spark, sf)
    ledger = w.events(spark, sf).filter(F.col("event_id") % 3 == 0).select("event_id")
    return audit.skip_handled(_seen_dup(log), ledger, ["event_id"]).select("event_id", "partition", "offset")


@query
def read_committed(spark, sf):
    return visibility.read_committed(w.txn_log(spark, sf), w.markers(spark, sf)).select("partition", "offset", "event_id")


@query
def visibility_report(spark, sf):
    return visibility.visibility_report(w.txn_log(spark, sf), w.markers(spark, sf))


@query
def eos_check(spark, sf):
    log = w.txn_log(spark, sf).withColumn("value", F.concat(F.col("key"), F.lit(":"), (F.col("event_id") % 3).cast("string")))
    return audit.eos_check(visibility.read_committed(log, w.markers(spark, sf)), visibility.read_uncommitted(log))


@query
def lag(spark, sf):
    log = w.log6(spark, sf)
    return progress.lag(progress.bounds(log), w.commits(log), group="g")


@query
def offsets_for_time(spark, sf):
    return progress.offsets_for_time(w.log6(spark, sf), F.lit("2024-01-30 20:00:00").cast("timestamp"))


@query
def reacquired(spark, sf):
    d = w.deliveries(spark, sf)
    held = d.filter((F.col("worker") == "w0") & (F.col("delivery") == 1))
    return audit.reacquired(held, d, ["topic", "partition", "offset"]).select("event_id", "worker", "delivery")


@query
def resolve_writer(spark, sf):
    rows = w.log6(spark, sf).withColumn("schema_id", F.col("event_id") % 30)
    versions = w.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("label"))
    return fo.resolve_writer(rows, versions).groupBy("writer").agg(F.count(F.lit(1)).alias("records"))


# ---- aggregations -----------------------------------------------------------------------------------------------

@query
def bounds(spark, sf):
    return progress.bounds(w.log6(spark, sf))


@query
def next_offsets(spark, sf):
    return progress.next_offsets(w.done(w.log6(spark, sf)))


@query
def delivery_audit(spark, sf):
    """After a crash and redelivery: what is missing and duplicated, per partition?"""
    log = w.log6(spark, sf).select("topic", "partition", "event_id")
    seen = _seen_dup(log).filter(F.col("event_id") % 11 != 0)
    return audit.delivery_audit(log, seen, ["partition", "event_id"], by=["partition"])


@query
def delivery_audit_lineitem(spark, sf):
    """Order lines against orders: natural duplicates, orders without lines, lines without an order."""
    lines = w.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return audit.delivery_audit(w.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), lines, ["id"])


def _round_summary(df):
    for c in ("elapsed_ms", "records_per_s", "mib_per_s", "p50_ms", "p99_ms", "max_ms"):
        df = df.withColumn(c, F.round(c, 6))
    return df


@query
def run_summary(spark, sf):
    return _round_summary(runs.run_summary(w.runs(spark, sf), w.QUERY_CHUNK))


@query
def rank_percentile(spark, sf):
    rows = w.table(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    return runs.rank_percentile(rows, "l_extendedprice", [0.0, 0.25, 0.5, 0.99, 1.0], ["l_suppkey"], w.QUERY_CHUNK)


@query
def worker_distribution(spark, sf):
    return queue.worker_distribution(w.deliveries(spark, sf))


@query
def delivery_totals(spark, sf):
    return queue.delivery_totals(w.deliveries(spark, sf), ["topic", "partition", "offset"])


@query
def outcome_counts(spark, sf):
    return queue.outcome_counts(w.deliveries(spark, sf), ["partition", "offset"], by=["partition"])


@query
def metric_table(spark, sf):
    return runs.metric_table(w.metrics(spark, sf), ["m0", "m1", "m2", "m3"], "event_id")


@query
def metric_sum(spark, sf):
    return runs.metric_sum(w.metrics(spark, sf).withColumn("value", F.round(F.col("value") * 100).cast("bigint")), "m2", "client-3")


@query
def bytes_by_node(spark, sf):
    return runs.bytes_by_node(w.metrics(spark, sf).withColumn("value", F.round(F.col("value") * 100).cast("bigint")), "m1")


@query
def weighted_mean(spark, sf):
    timers = w.events(spark, sf).select("event_type", (F.col("event_id") % 5).alias("count"),
                                        F.round(F.col("value") * 100).cast("bigint").alias("total"))
    return runs.weighted_mean(timers, ["event_type"]).withColumn("mean", F.round("mean", 6))


@query
def transit_latency(spark, sf):
    log = w.log6(spark, sf, keep=("event_id",))
    stamped = hdr.stamp_sent_at(log, F.when(F.col("event_id") % 4 != 0, F.col("timestamp"))).withColumn(
        "headers", F.when(F.col("event_id") % 4 == 0, hdr.no_headers()).otherwise(F.col("headers")))
    consumed = F.unix_millis("timestamp") + F.col("event_id") % 1000
    return runs.transit_latency(stamped, consumed, ["partition"]).withColumn("mean_ms", F.round("mean_ms", 6))


@query
def wire_size(spark, sf):
    rows = hdr.with_headers(fo.encode_orders(w.orders_rows(spark, sf)), {fo.TYPE_HEADER: "order"})
    narrow_json = F.to_json(F.struct(F.col("order.orderId").alias("orderId"), F.col("order.currency").alias("currency")))
    return runs.wire_size(rows, {"json": F.col("value"), "narrow": narrow_json}, "headers").select(
        "format", "records", F.round("value_bytes", 6).alias("value_bytes"), F.round("header_bytes", 6).alias("header_bytes"))


# ---- ordered analytics ------------------------------------------------------------------------------------------

@query
def batches(spark, sf):
    log = w.done(w.log6(spark, sf))
    return progress.batches(log, 500, w.QUERY_CHUNK).select("partition", "offset", "batch")


@query
def batch_report(spark, sf):
    return progress.batch_report(w.log6(spark, sf), 500)


@query
def last_n(spark, sf):
    return progress.last_n(w.log6(spark, sf), 100).select("partition", "offset", "event_id")


@query
def replay_from_time(spark, sf):
    return progress.replay(w.log6(spark, sf), from_time=F.lit("2024-01-15 12:00:00").cast("timestamp")).select(
        "partition", "offset", "event_id")


@query
def rewind(spark, sf):
    log = w.log6(spark, sf)
    at = F.col("committed") * 0 + 1
    history = w.commits(log).filter("group = 'g'").withColumn("committed_at", at)
    other = history.withColumn("group", F.lit("h"))
    rewound = progress.rewind(history.unionByName(other), progress.bounds(log), "g", F.lit(2).cast("bigint"))
    return progress.latest_commits(rewound)


@query
def done_watermark(spark, sf):
    log = w.log6(spark, sf)
    return progress.done_watermark(log, w.done(log))


@query
def ledger_runs(spark, sf):
    """Handled positions stored in four batches that interleave, read as merged runs."""
    handled = w.done(materialised(w.log6(spark, sf).select("topic", "partition", "offset", "event_id")))
    store = ledger.RunLedger(spark, shared_folder(spark), w.QUERY_CHUNK)
    for i in range(4):
        store.add(ledger.runs_of(handled.filter(F.col("event_id") % 4 == i), w.QUERY_CHUNK))
    return store.runs()


@query
def ledger_watermark(spark, sf):
    """The done watermark from the index of a written log and the runs of what was handled."""
    path = shared_folder(spark)
    source.append_log(_rows_to_append(spark, sf), path, "event_id", w.PARTITIONS, chunk_rows=w.QUERY_CHUNK)
    return ledger.watermark_of_runs(segments.index_bounds(spark, path), ledger.runs_of(w.done(w.log6(spark, sf)), w.QUERY_CHUNK))


@query
def skip_handled_by_runs(spark, sf):
    log = w.log6(spark, sf)
    runs_done = ledger.runs_of(log.filter(F.col("event_id") % 3 == 0), w.QUERY_CHUNK)
    return ledger.skip_runs(_seen_dup(log), runs_done, w.QUERY_CHUNK).select("event_id", "partition", "offset")


@query
def stop_at_failure(spark, sf):
    log = w.log6(spark, sf)
    return progress.stop_at_failure(log, F.col("event_id") % 1009 == 900).select("partition", "offset", "event_id")


@query
def failure_report(spark, sf):
    return progress.failure_report(w.log6(spark, sf), F.col("event_id") % 1009 == 900)


@query
def attempt_no(spark, sf):
    d = w.deliveries(spark, sf).withColumn("seq", F.col("event_id") * 8 + F.col("delivery"))
    return timelines.attempt_no(d, ["topic", "partition", "offset"], "seq", w.QUERY_CHUNK).select("event_id", "delivery", "attempt")


@query
def attempt_report(spark, sf):
    return timelines.attempt_report(w.deliveries(spark, sf), ["offset"], ["topic", "partition"])


@query
def first_seen(spark, sf):
    replayed = progress.last_n(w.log6(spark, sf), 100)
    return progress.first_seen(replayed, "offset")


@query
def uncommitted_exposure(spark, sf):
    """Positions move with every record, commits follow every tenth; sampled per day."""
    log = w.log6(spark, sf)
    day = F.floor(F.unix_seconds("timestamp") / 86400).cast("bigint").alias("tick")
    place = log.select(F.lit("g").alias("group"), "topic", "partition", day, "offset")
    positions = place.groupBy("group", "topic", "partition", "tick").agg((F.max("offset") + 1).alias("position"))
    committed = place.filter(F.col("offset") % 10 == 9).groupBy("group", "topic", "partition", "tick").agg(
        (F.max("offset") + 1).alias("committed"))
    return progress.uncommitted_exposure(positions, committed, F.floor(F.col("tick") / 1000).cast("bigint"))


@query
def poll_overruns(spark, sf):
    return timelines.poll_overruns(w.polls(spark, sf), ["topic", "partition"], "offset", "poll_us", 86_400_000_000, w.QUERY_CHUNK).select(
        "partition", "offset", "poll_us", "gap_us")


@query
def idle_periods(spark, sf):
    return timelines.idle_periods(w.log6(spark, sf), 7_200_000_000, chunk_rows=w.QUERY_CHUNK).select(
        "partition", "offset", "idle_from_us", "idle_to_us", "idle_us")


@query
def pause_intervals(spark, sf):
    inflight = w.events(spark, sf).select(F.col("event_type").alias("source"), "event_id", "value")
    return timelines.pause_intervals(inflight, ["source"], "event_id", "value", 100.0, 5.0, w.QUERY_CHUNK)


@query
def fence_zombies(spark, sf):
    e = F.col("event_id")
    epoch = F.floor(e / 500)
    late = F.when(e % 97 == 0, F.greatest(epoch - 1, F.lit(0))).otherwise(epoch).cast("bigint")
    writer = F.when(e % 89 != 0, F.concat(F.lit("t-"), (F.col("user_id") % 3).cast("string")))
    log = w.events(spark, sf).select(writer.alias("transactional_id"),
                                     late.alias("epoch"), e.alias("log_order"))
    return visibility.fence_zombies(log, "log_order", w.QUERY_CHUNK)


@query
def dedup_retries(spark, sf):
    """Every seventh record was written twice; the copy sits at a later offset. Records without a producer are no retries."""
    log = w.log6(spark, sf).select("topic", "partition", "offset", "event_id",
                                   F.when(F.col("event_id") % 13 != 0, F.concat(F.lit("p"), (F.col("event_id") % 3).cast("string"))).alias("producer_id"),
                                   F.floor(F.col("event_id") / 3).alias("sequence"))
    copies = log.filter(F.col("event_id") % 7 == 0).withColumn("offset", F.col("offset") + 1_000_000_000)
    return audit.dedup_retries(log.unionByName(copies)).select("partition", "offset", "event_id", "producer_id", "sequence")


@query
def rebalance_cost(spark, sf):
    callbacks, marks = w.rebalance_events(spark, sf)
    return timelines.rebalance_cost(callbacks, marks, "at", w.QUERY_CHUNK)


@query
def outage_timeline(spark, sf):
    acks = w.runs(spark, sf)
    labels = w.events(spark, sf).filter(F.col("event_id") % 500 == 0).select(
        F.col("event_type").alias("run"), F.floor(F.unix_micros("ts") / 3_600_000_000).cast("bigint").alias("tick"), F.lit("stop").alias("label"))
    return runs.outage_timeline(acks, labels, every_s=3600, chunk_ticks=240)


@query
def head_of_line(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf))
    policy = failures.RetryPolicy()
    later = failures.RetryPolicy(initial_ms=1000, max_ms=10_000)
    blocking = failures.retry_in_place(log, failures.scripted_handler, policy, w.QUERY_CHUNK).select(
        F.lit("blocking").alias("strategy"), "kind", F.col("due_ms").alias("since_send"))
    moving = failures.retry_topic_entries(log, failures.scripted_handler, later).select(
        F.lit("non-blocking").alias("strategy"), "kind", F.col("due_ms").alias("since_send"))
    return runs.head_of_line(blocking.unionByName(moving))


@query
def counter_rate(spark, sf):
    """A counter per event type that restarts every day."""
    day = F.floor(F.unix_seconds("ts") / 86400).cast("bigint")
    rows = w.events(spark, sf).select("event_type", day.alias("day"), "event_id", F.unix_micros("ts").alias("at_us"),
                                      (F.col("event_id") % 5 + 1).alias("n"))
    samples = scans.scan(rows, ["event_type", "day"], ["event_id"], scans.id_chunk("event_id", w.QUERY_CHUNK),
                         total=scans.running_sum(F.col("n")))
    out = runs.counter_rate(samples, ["event_type"], "event_id", "at_us", "total", 86_400, w.QUERY_CHUNK)
    for c in ("elapsed_s", "rate_elapsed", "rate_window"):
        out = out.withColumn(c, F.round(c, 6))
    return out


# ---- sorts, limits, sets ----------------------------------------------------------------------------------------

@query
def offset_ranges(spark, sf):
    log = w.log6(spark, sf).withColumn("batch", F.floor(F.col("event_id") / 500))
    both = log.unionByName(log.withColumn("topic", F.lit("copies")).withColumn("offset", F.col("offset") + 1))
    return progress.offset_ranges(both, ["batch"])


@query
def timeline(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf))
    attempts = failures.retry_in_place(log, failures.scripted_handler, failures.RetryPolicy(), w.QUERY_CHUNK)
    return timelines.timeline(attempts.select("due_ms", "partition", "offset", "attempt", "key", "error"),
                              ["due_ms", "partition", "offset", "attempt"], 50)


@query
def assignment_delta(spark, sf):
    """Which users' event types appear in one half of the month and not in the other."""
    e = w.events(spark, sf)
    half = F.lit("2024-01-16").cast("timestamp")
    member = F.concat(F.lit("m"), (F.col("user_id") % 50).cast("string")).alias("member")
    part = (F.col("event_id") % 37).alias("partition")
    return timelines.assignment_delta(e.filter(F.col("ts") < half).select(member, part), e.filter(F.col("ts") >= half).select(member, part))


# ---- serialization and schemas ----------------------------------------------------------------------------------

@query
def encode_orders(spark, sf):
    rows = w.orders_rows(spark, sf).withColumn("order", F.when(F.col("o_orderkey") % 31 != 0, F.col("order")))
    return fo.encode_orders(rows).select("o_orderkey", "value")


@query
def decode_orders_good(spark, sf):
    good, _ = fo.decode_orders(w.orders_json(spark, sf))
    return good.select("o_orderkey", F.col("order.orderId").alias("orderId"), F.col("order.customerId").alias("customerId"),
                       F.col("order.totalAmount").cast("string").alias("totalAmount"), F.col("order.currency").alias("currency"),
                       F.unix_micros("order.createdAt").alias("created_us"))


@query
def decode_orders_bad(spark, sf):
    _, bad = fo.decode_orders(w.orders_json(spark, sf))
    return bad.select("o_orderkey", "value", F.col("decode_error").alias("reason"))


ROUTE_SCHEMAS = {
    "order": fo.ORDER_SCHEMA,
    "view": fo.ORDER_VIEW_SCHEMA,
}


def _typed_orders(spark, sf):
    k = F.col("o_orderkey")
    token = F.when(k % 3 == 0, "order").when(k % 3 == 1, "view").otherwise("legacy")
    typed = hdr.with_headers(w.orders_json(spark, sf), {fo.TYPE_HEADER: token})
    return typed.withColumn("headers", F.when(k % 10 == 0, hdr.no_headers()).otherwise(F.col("headers")))


@query
def route_by_type(spark, sf):
    routed = fo.route_by_type(_typed_orders(spark, sf), ROUTE_SCHEMAS)
    return routed.select("o_orderkey", "type_token", F.col("as_order.customerId").alias("order_customer"),
                         F.col("as_view.orderId").alias("view_order"), "route_error")


@query
def route_by_default(spark, sf):
    """The consumer ignores the header and reads everything as its own view."""
    routed = fo.route_by_type(_typed_orders(spark, sf), {"view": fo.ORDER_VIEW_SCHEMA}, default="view", use_header=False)
    return routed.select("o_orderkey", F.col("as_view.orderId").alias("view_order"), "route_error")


@query
def route_remapped(spark, sf):
    """The header is used, but its tokens stand for the consumer's own type."""
    routed = fo.route_by_type(_typed_orders(spark, sf), {"order": fo.ORDER_VIEW_SCHEMA, "view": fo.ORDER_VIEW_SCHEMA})
    return routed.select("o_orderkey", F.coalesce("as_order.orderId", "as_view.orderId").alias("order_id"), "route_error")


@query
def wire_header(spark, sf):
    k = F.col("event_id")
    framed = fo.add_wire_header(F.col("event_type"), k % 70000)
    rows = w.events(spark, sf).select("event_id", F.when(k % 23 == 0, F.lit("x")).when(k % 29 == 0, F.lit("plain text")).otherwise(
        F.lit(None)).cast("binary").alias("bad"), framed.alias("framed")).select("event_id", F.coalesce("bad", "framed").alias("value"))
    return fo.wire_header(rows).select("event_id", "schema_id", F.col("body").cast("string").alias("body"), "wire_error")


@query
def subject_name(spark, sf):
    strategy = F.when(F.col("event_id") % 3 == 0, "topic").when(F.col("event_id") % 3 == 1, "record").otherwise("topic-record")
    return w.events(spark, sf).select("event_id", fo.subject_name(F.concat(F.lit("events."), F.col("event_type")), F.lit("shop.Event"), strategy).alias("subject"))


@query
def schema_compat(spark, sf):
    return schemas.schema_compat(w.schema_fields(spark, sf))


@query
def schema_compat_transitive(spark, sf):
    return schemas.schema_compat_transitive(w.schema_fields(spark, sf))


@query
def register_gate(spark, sf):
    """Each user's versions offered in order; the level depends on the user."""
    fields = w.schema_fields(spark, sf).withColumnRenamed("version", "candidate").withColumn("candidate", F.col("candidate").cast("bigint"))
    number = F.regexp_extract("subject", r"(\d+)$", 1).cast("int")
    levels = ["BACKWARD", "FORWARD", "FULL", "BACKWARD_TRANSITIVE", "FORWARD_TRANSITIVE", "FULL_TRANSITIVE", "NONE"]
    level = F.get(F.array(*[F.lit(x) for x in levels]), number % len(levels))
    return schemas.register_gate(fields, fields.select("subject").distinct().withColumn("level", level))


# Fields of the order schema and its three later versions; each row says which version wrote it.
WRITER_FIELDS = {
    "v1": {"orderId": "string", "customerId": "string", "currency": "string"},
    "v2": {"orderId": "string", "customerId": "string", "currency": "string", "channel": "string"},
    "v3": {"orderId": "string", "currency": "string", "channel": "string"},
    "v4": {"orderId": "string", "customerId": "string", "currency": "int"},
}
READER_FIELDS = [("orderId", "string", None, False), ("customerId", "string", None, False),
                 ("currency", "string", "EUR", True), ("channel", "string", "web", True)]


@query
def read_as(spark, sf):
    k = F.col("o_orderkey")
    rows = w.orders_rows(spark, sf).select("o_orderkey", F.concat(F.lit("v"), (k % 5 + 1).cast("string")).alias("writer"), F.create_map(
        F.lit("orderId"), F.col("order.orderId"), F.lit("customerId"), F.col("order.customerId"),
        F.lit("currency"), F.lit("USD"), F.lit("channel"), F.lit("mobile")).alias("payload"))
    return schemas.read_as(rows, WRITER_FIELDS, READER_FIELDS).select(
        "o_orderkey", "reject_reason", "r_orderId", "r_customerId", "r_currency", "r_channel")


# ---- failure handling -------------------------------------------------------------------------------------------

@query
def classify_error(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf))
    verdict = failures.classify_error(failures.scripted_handler(F.lit(1)), [failures.TRANSIENT], [failures.FATAL])
    return log.select("event_id", "kind", verdict.alias("verdict"))


@query
def backoff_schedule(spark, sf):
    policy = failures.RetryPolicy(initial_ms=200, multiplier=2.0, max_ms=700, retries=4)
    rows = w.events(spark, sf).select("event_id")
    return failures.backoff_schedule(rows, policy).select("event_id", "retry", "delay_ms", "due_ms")


@query
def retry_in_place(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf))
    return failures.retry_in_place(log, failures.scripted_handler, failures.RetryPolicy(), w.QUERY_CHUNK).select(
        "event_id", "partition", "attempt", "error", "due_ms", "final_error")


@query
def retry_topics(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf))
    policy = failures.RetryPolicy(initial_ms=1000, max_ms=10_000)
    return failures.retry_topic_entries(log, failures.scripted_handler, policy).select("event_id", "attempt", "error", "due_ms", "via")


@query
def dead_letters(spark, sf):
    log = records.parse_plan(w.retry_log(spark, sf).withColumn("value", F.col("value").cast("binary")))
    tried = failures.with_attempts(log, failures.scripted_handler, failures.RetryPolicy())
    message = F.concat(F.col("kind"), F.lit(" by script: "), F.col("key"))
    dead = failures.dead_letters(tried, failures.final_error(), message=message)
    return dead.select("topic", "partition", "key", F.hex("value").alias("value_hex"), "original_topic", "original_offset",
                       F.unix_micros("original_timestamp").alias("original_us"), "error_class", "error_message")


@query
def publish_dead_letters(spark, sf):
    """Dead letters appended to their own log and read back: same partition, same bytes, the error in headers."""
    folder = shared_folder(spark)
    log = records.parse_plan(w.retry_log(spark, sf).withColumn("value", F.col("value").cast("binary")))
    tried = failures.with_attempts(log, failures.scripted_handler, failures.RetryPolicy())
    failures.publish_dead_letters(failures.dead_letters(tried, failures.final_error()), folder, w.PARTITIONS)
    back = source.read_log(spark, folder, "orders-dlt")
    header = lambda name: hdr.header_text(F.col("headers"), name)
    return back.select("partition", "offset", "key", F.hex("value").alias("value_hex"),
                       header("original-offset").cast("bigint").alias("original_offset"), header("error-class").alias("error_class"))


@query
def nack(spark, sf):
    """Polls of 300 records; the records at two places of every 400 are nacked once."""
    nacked = (F.col("offset") % 400).isin(250, 260)
    return progress.nack_deliveries(w.log6(spark, sf), nacked, F.lit(0), 1000, 300, w.QUERY_CHUNK).select(
        "partition", "offset", "poll", "attempt", "t_ms", "action")


# ---- queue ------------------------------------------------------------------------------------------------------

@query
def queue_worker(spark, sf):
    return w.deliveries(spark, sf).select("event_id", "delivery", "type", "worker")


@query
def queue_recoverer(spark, sf):
    rows = w.log6(spark, sf).select("topic", "partition", "offset")
    acked = queue.queue_worker(rows, lambda d: queue.scripted_decision("recoverer", F.col("offset"), d), 5)
    return queue.outcome_counts(acked, ["partition", "offset"])


def _queue_state(spark, sf, lock_us):
    return queue.queue_state(w.lock_acks(spark, sf), ["topic", "partition", "offset"], "seq", limit=2, lock_us=lock_us,
                             chunk_rows=w.QUERY_CHUNK * 8).select("partition", "offset", "state", "deliveries", "applied", "refused", "expired")


@query
def queue_state_short_lock(spark, sf):
    return _queue_state(spark, sf, 2_000_000)


@query
def queue_state_long_lock(spark, sf):
    return _queue_state(spark, sf, 10_000_000)


@query
def queue_state_renewed(spark, sf):
    """Slow records renew their lock after 1.5 s, so even the short lock holds; every third renewal comes too late."""
    acks = w.lock_acks(spark, sf)
    slow = acks.filter(F.col("event_id") % 20 == 0)
    wait = F.when(F.col("event_id") % 60 == 0, 2_500_000).otherwise(1_500_000)
    renewals = slow.select("topic", "partition", "offset", "event_id", "delivery", "worker", F.lit("RENEW").alias("type"), "delivered_us",
                           (F.col("delivered_us") + wait).alias("acked_us"), (F.col("seq") * 2).alias("seq"))
    both = acks.withColumn("seq", F.col("seq") * 2 + 1).unionByName(renewals)
    return queue.queue_state(both, ["topic", "partition", "offset"], "seq", limit=2, lock_us=2_000_000,
                             chunk_rows=w.QUERY_CHUNK * 16).select("partition", "offset", "state", "deliveries", "applied", "refused", "expired")


@query
def judge_acks(spark, sf):
    """Each ack with whether it still counted under the short lock."""
    judged = queue.judge_acks(w.lock_acks(spark, sf), ["topic", "partition", "offset"], "seq", 2_000_000, w.QUERY_CHUNK * 8)
    return judged.select("event_id", "delivery", "type", "applied")


@query
def recover(spark, sf):
    """Acks for handler errors by class: transient ones come back, the rest does not."""
    log = records.parse_plan(w.retry_log(spark, sf))
    error = failures.scripted_handler(F.lit(1))
    return log.select("event_id", queue.recover(error, [failures.TRANSIENT]).alias("type"))


# ---- handlers ---------------------------------------------------------------------------------------------------

def _number_handler(record) -> None:
    if record["event_id"] % 1009 == 900:
        raise ValueError(f"record {record['event_id']}")


@query
def process_in_order(spark, sf):
    """A Python handler in offset order; a failed record stops its partition."""
    rows = w.log6(spark, sf).select("topic", "partition", "offset", "event_id")
    handled = handlers.process_in_order(rows, handlers.guard(_number_handler), handlers.guarded_schema(rows), w.QUERY_CHUNK)
    return progress.stop_at_failure(handled, F.col("status") == "error").select("partition", "offset", "event_id", "status")


def _double(frame):
    frame["twice"] = frame["event_id"] * 2
    frame["calls_ok"] = len(frame) <= 500
    return frame


@query
def process_in_batches(spark, sf):
    rows = w.events(spark, sf).select("event_id")
    return handlers.process_in_batches(rows, _double, "event_id bigint, twice bigint, calls_ok boolean", 500)


@query
def process_unordered(spark, sf):
    rows = w.events(spark, sf).select("event_id")
    return handlers.process_unordered(rows, _double, "event_id bigint, twice bigint", 8).select("event_id", "twice")


def register_streams() -> None:
    """Streaming queries live in their own module and register themselves when it is imported."""
    from tidelog.streaming import queries as _  # noqa: F401


register_streams()

"""Inputs the registered queries derive from the given tables, at any size: logs, acks, polls, transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.orders import encode_order
from tidelog.operators.progress import bounds
from tidelog.operators.queue import queue_worker, scripted_decision
from tidelog.plans.scans import CHUNK_ROWS
from tidelog.sources.log import as_log

PARTITIONS = 6
# Chunk length of the ordered scans in the registered queries.
QUERY_CHUNK = CHUNK_ROWS


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from a footer once and then reused."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def user_key() -> Column:
    return F.concat(F.lit("customer-"), (F.col("user_id") % 20).cast("string"))


def vip_key() -> Column:
    return F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("vip-"), (F.col("event_id") % 3).cast("string"))).otherwise(user_key())


def event_value() -> Column:
    return F.to_json(F.struct("event_id", "event_type", "value"))


def log6(spark: SparkSession, sf_dir: str, key: Column | None = None, value: Column | None = None,
         keep: tuple[str, ...] = ("event_id",), topic: str = "events") -> DataFrame:
    """Events as a log of six partitions."""
    return as_log(events(spark, sf_dir), topic, user_key() if key is None else key,
                  event_value() if value is None else value, F.col("ts"), "event_id", PARTITIONS,
                  keep=keep, chunk_rows=QUERY_CHUNK)


def commits(log: DataFrame) -> DataFrame:
    """Group g committed 80 % of each partition but the last, which it never committed; group h committed one record of each."""
    mine = F.when(F.col("partition") != PARTITIONS - 1, F.struct(F.lit("g").alias("group"), F.floor(F.lit(0.8) * F.col("end")).cast("bigint").alias("committed")))
    other = F.struct(F.lit("h").alias("group"), F.lit(1).cast("bigint").alias("committed"))
    each = bounds(log).select("topic", "partition", F.inline(F.filter(F.array(mine, other), lambda s: s.isNotNull())))
    return each.select("group", "topic", "partition", "committed")


def done(log: DataFrame) -> DataFrame:
    """Acknowledged records, with holes."""
    return log.filter(F.col("event_id") % 101 != 7)


def txn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in transactions of 50."""
    return log6(spark, sf_dir, key=F.concat(F.lit("t"), (F.floor(F.col("event_id") / 50) % 7).cast("string"), F.lit("-"),
                                            (F.col("user_id") % 20).cast("string")),
                keep=("event_id",)).withColumn("txn_id", F.concat(F.lit("t-"), F.floor(F.col("event_id") / 50).cast("string")))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of each transaction; the sixth-last one is open and has no marker."""
    txns = events(spark, sf_dir).select(F.floor(F.col("event_id") / 50).alias("txn")).distinct()
    newest = events(spark, sf_dir).agg(F.floor(F.max("event_id") / 50)).scalar()
    return txns.filter(F.col("txn") != newest - 5).select(
        F.concat(F.lit("t-"), F.col("txn").cast("string")).alias("txn_id"),
        F.when(F.col("txn") % 7 == 0, "abort").otherwise("commit").alias("outcome"))


def retry_key() -> Column:
    e = F.col("event_id").cast("string")
    m = F.col("event_id") % 10
    return (
        F.when(m == 0, F.concat(F.lit("fatal-"), e)).when(m == 1, F.concat(F.lit("poison-"), e))
        .when(m == 2, F.concat(F.lit("flaky2-"), e)).when(m == 3, F.concat(F.lit("flaky9-"), e))
        .otherwise(F.concat(F.lit("ok-"), e)))


def retry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scripted keys; poison rows carry a value that is not JSON. Partitioned by event number, for an even load."""
    value = F.when(F.col("event_id") % 10 == 1, F.lit("{not json")).otherwise(event_value())
    return as_log(events(spark, sf_dir), "orders", retry_key(), value, F.col("ts"), "event_id", PARTITIONS,
                  partition=F.col("event_id") % PARTITIONS, keep=("event_id",), chunk_rows=QUERY_CHUNK)


def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("orderId"),
            F.concat(F.lit("customer-"), (F.col("o_custkey") % 20).cast("string")).alias("customerId"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("totalAmount"),
            F.lit("EUR").alias("currency"),
            F.col("o_orderdate").cast("timestamp").alias("createdAt")).alias("order"))


def orders_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order JSON with nulls, broken values and an unknown extra field mixed in."""
    k = F.col("o_orderkey")
    plain = encode_order(F.col("order"))
    extra = F.concat(F.expr("left(plain, length(plain) - 1)"), F.lit(',"channel":"web"}'))
    rows = orders_rows(spark, sf_dir).withColumn("plain", plain)
    return rows.select("o_orderkey", F.when(k % 31 == 0, None).when(k % 29 == 0, "{not json").when(
        k % 5 == 0, extra).otherwise(F.col("plain")).alias("value"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue deliveries and acks under the explicit script: worker = event number mod 4."""
    rows = log6(spark, sf_dir).select("topic", "partition", "offset", "event_id", F.unix_micros("timestamp").alias("ts_us"))
    acked = queue_worker(rows, lambda d: scripted_decision("explicit", F.col("event_id"), d), limit=5)
    return acked.withColumn("worker", F.concat(F.lit("w"), ((F.col("event_id") + F.col("delivery") - 1) % 4).cast("string")))


def lock_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acks with times: one second after delivery, three for every 20th record."""
    took = F.when(F.col("event_id") % 20 == 0, 3_000_000).otherwise(1_000_000)
    delivered = F.col("ts_us") + (F.col("delivery") - 1) * 10_000_000
    return deliveries(spark, sf_dir).select(
        "topic", "partition", "offset", "event_id", "delivery", "worker", "type", delivered.alias("delivered_us"),
        (delivered + took).alias("acked_us"), (F.col("event_id") * 8 + F.col("delivery")).alias("seq"))


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll times: every 50th record of a partition."""
    return log6(spark, sf_dir).filter(F.col("offset") % 50 == 0).select(
        "topic", "partition", "offset", F.unix_micros("timestamp").alias("poll_us"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event type; latency from the value, every 40th record failed."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("run"), F.unix_micros("ts").alias("sent_us"), F.col("value").alias("latency_ms"),
        F.octet_length("props").alias("bytes"), (F.col("event_id") % 40 == 0).alias("failed"),
        (F.unix_micros("ts") + F.round(F.col("value") * 1000).cast("bigint")).alias("done_us"),
        (F.col("event_id") % 3).alias("retries"), "event_id")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of three metrics; even events are client-level, odd ones per node."""
    client = F.concat(F.lit("client-"), (F.col("user_id") % 5).cast("string"))
    node = F.concat(F.lit("node-"), (F.col("event_id") % 3 + 1).cast("string"))
    tags = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("client-id"), client)).otherwise(
        F.create_map(F.lit("client-id"), client, F.lit("node-id"), node))
    return events(spark, sf_dir).select(
        F.col("event_type").alias("run"), F.concat(F.lit("m"), (F.col("event_id") % 4).cast("string")).alias("name"),
        tags.alias("tags"), "value", "event_id")


def schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema versions per user: one version per five days, its fields the event types seen in it."""
    e = F.col("event_id")
    kind = F.when(F.min(e) % 11 == 0, "long").when(F.min(e) % 11 == 1, "string").otherwise("int")
    return events(spark, sf_dir).groupBy(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("subject"),
        F.floor((F.dayofmonth("ts") - 1) / 5).cast("int").alias("version"),
        F.col("event_type").alias("field"),
    ).agg(kind.alias("type"), (F.min(e) % 2 == 0).alias("has_default"))


def rebalance_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rebalance callbacks and marks: one group per 10 users, every 25th event is a mark."""
    base = events(spark, sf_dir).select(
        F.concat(F.lit("g"), (F.col("user_id") % 10).cast("string")).alias("group"), F.col("event_id").alias("at"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("member"), "event_type")
    action = F.when(F.col("event_type").isin("click", "view"), "assigned").when(
        F.col("event_type") == "error", "LOST").otherwise("revoked")
    moved = F.sequence(F.lit(0), (F.col("at") % 6).cast("int"))
    callbacks = base.filter(F.col("at") % 25 != 0).select("group", "at", "member", action.alias("action"), moved.alias("partitions"))
    marks = base.filter(F.col("at") % 25 == 0).select("group", "at", F.concat(F.lit("mark-"), F.col("at").cast("string")).alias("mark"))
    return callbacks, marks

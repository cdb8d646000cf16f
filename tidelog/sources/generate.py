"""Deterministic record generators and topping a log up to a size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.keys import key_partition
from tidelog.sources.log import append_log
from tidelog.sources.segments import log_index

STATIONS = ["harbour", "ridge", "meadow", "quarry", "delta"]
ORDER_CUSTOMERS = 20


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def customer_key(seq: Column, cardinality: int) -> Column:
    """``customer-<n>`` with a bounded number of distinct keys."""
    return F.concat(F.lit("customer-"), (seq % cardinality).cast("string"))


def order_struct(seq: Column, created_at: Column) -> Column:
    """A deterministic order row for a sequence number."""
    cents = F.lit(10) + seq % 990 + (seq % 100) * 100
    return F.struct(
        F.concat(F.lit("ORD-"), seq.cast("string")).alias("orderId"),
        customer_key(seq, ORDER_CUSTOMERS).alias("customerId"),
        (cents.cast("decimal(20,0)") / F.lit(100)).cast("decimal(12,2)").alias("totalAmount"),
        F.lit("EUR").alias("currency"),
        created_at.alias("createdAt"),
    )


def gen_orders(ids: DataFrame, seq: str, created_at: Column) -> DataFrame:
    """One order per row of ``ids``."""
    return ids.select(F.col(seq).alias("seq"), order_struct(F.col(seq), created_at).alias("order")).select("seq", "order.*")


def payload_json(seq: Column, size: int) -> Column:
    """JSON of a sensor's report, of roughly ``size`` bytes: as many four-digit readings as fit behind its head."""
    readings = F.transform(F.sequence(F.lit(1), F.lit(max(1, (size - 50) // 5))), lambda i: (1000 + (seq * 37 + i * 101) % 9000).cast("string"))
    return F.concat(F.lit('{"seq":'), seq.cast("string"), F.lit(',"station":"'), F.get(_texts(STATIONS), (seq % len(STATIONS)).cast("int")),
                    F.lit('","readings":['), F.array_join(readings, ","), F.lit("]}"))


def gen_payload(ids: DataFrame, seq: str, size: int, cardinality: int) -> DataFrame:
    """Keyed JSON records of roughly ``size`` bytes."""
    return ids.select(F.col(seq).alias("seq"), customer_key(F.col(seq), cardinality).alias("key"),
                      payload_json(F.col(seq), size).alias("value"))


def random_text(seq: Column, size: int, seed: int = 0) -> Column:
    """Incompressible printable text, the same for the same ``seq`` whichever task computes it."""
    blocks = F.transform(F.sequence(F.lit(0), F.lit(-(-size // 43) - 1)),
                         lambda i: F.rtrim(F.base64(F.unhex(F.sha2(
                             F.concat_ws(":", F.lit(seed), seq.cast("string"), i.cast("string")), 256))), F.lit("=")))
    return F.substring(F.array_join(blocks, ""), 1, size)


def gen_random(ids: DataFrame, seq: str, size: int, cardinality: int, seed: int = 0) -> DataFrame:
    return ids.select(F.col(seq).alias("seq"), customer_key(F.col(seq), cardinality).alias("key"),
                      random_text(F.col(seq), size, seed).alias("value"))


def paced_stream(spark: SparkSession, rows_per_second: int, size: int = 512, cardinality: int = 100) -> DataFrame:
    """A steady stream of generated records."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select("timestamp", F.col("value").alias("seq"), customer_key(F.col("value"), cardinality).alias("key"),
                       payload_json(F.col("value"), size).alias("payload")).withColumnRenamed("payload", "value")


def top_up(spark: SparkSession, path: str, topic: str, n: int, target: int, size: int = 512,
           cardinality: int = 100, at: Column | None = None, ids: DataFrame | None = None) -> int:
    """Write only the rows missing up to ``target``; returns how many the topic holds afterwards.

    Rows are made for the numbers 0 to target - 1, or for the rows of ``ids`` whose ``id`` is among them. A row that
    cannot be placed fails the call before anything is written.
    """
    present = _held(spark, path, topic)
    if present >= target:
        return present
    # Keys count from the first missing row, sequence numbers go on from what is there.
    missing = spark.range(present, target) if ids is None else ids.select("id").filter(F.col("id").between(present, target - 1))
    rows = gen_payload(missing, "id", size, cardinality).withColumn(
        "key", customer_key(F.col("seq") - present, cardinality)).select(
        F.lit(topic).alias("topic"), key_partition(F.col("key"), n).alias("partition"),
        (F.current_timestamp() if at is None else at).alias("timestamp"), "key", "value", "seq")
    append_log(rows, path, "seq", n, all_or_nothing=True)
    return _held(spark, path, topic)


def _held(spark: SparkSession, path: str, topic: str) -> int:
    """Records of a topic, by the index."""
    return log_index(spark, path).filter(F.col("topic") == topic).agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]

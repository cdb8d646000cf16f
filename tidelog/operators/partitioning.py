"""Where keys land and how uneven that is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.keys import round_robin_partition, salted_key, tenant_partition
from tidelog.plans import scans


def partition_spread(df: DataFrame) -> DataFrame:
    """Records and share in percent per partition."""
    counts = df.groupBy("partition").agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records")).scalar()
    return counts.select("partition", "records", F.round(F.lit(100.0) * F.col("records") / total, 1).alias("share"))


def key_partitions(df: DataFrame) -> DataFrame:
    """Distinct (key, partition) pairs with their record counts; one key shuffles as few partial rows per task."""
    return df.groupBy("key", "partition").agg(F.count(F.lit(1)).alias("records"))


def moved_keys(df: DataFrame) -> DataFrame:
    """Keys seen on more than one partition."""
    return key_partitions(df).groupBy("key").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("records").alias("records")).filter(F.col("partitions") > 1)


def moved_keys_report(df: DataFrame) -> DataFrame:
    """Distinct keys, and how many of them were seen on more than one partition."""
    per_key = key_partitions(df).groupBy("key").agg(F.count(F.lit(1)).alias("partitions"))
    return per_key.agg(F.count("key").alias("distinct_keys"),
                       F.count_if((F.col("partitions") > 1) & F.col("key").isNotNull()).alias("moved_keys"))


def hot_keys(df: DataFrame, k: int) -> DataFrame:
    """The k heaviest keys and their share in percent; equal counts are ordered by key."""
    counts = df.groupBy("key").agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records")).scalar()
    top = counts.orderBy(F.desc("records"), F.asc_nulls_first("key")).limit(k)
    return top.select("key", "records", F.round(F.lit(100.0) * F.col("records") / total, 2).alias("share"))


def number_records(df: DataFrame, order: str, out: str, by: tuple[str, ...] = ("topic",),
                   chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """A dense 0-based counter along a unique integer column."""
    return scans.scan_measured(df, by, order, chunk_rows, **{out: scans.index()})


def assign_tenants(df: DataFrame, n: int, order: str, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Tenant placement; rows without a key take turns over partitions 1..n-1."""
    keyless = df.withColumn("__has_key", F.col("key").isNotNull())
    numbered = scans.scan_measured(keyless, ["topic", "__has_key"], order, chunk_rows, __turn=scans.index())
    return numbered.withColumn("partition", tenant_partition(F.col("key"), n, F.col("__turn"))).drop("__turn", "__has_key")


def ignore_keys(df: DataFrame, n: int, order: str, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Even spread over n partitions whatever the key."""
    numbered = number_records(df, order, "__turn", chunk_rows=chunk_rows)
    return numbered.withColumn("partition", round_robin_partition(F.col("__turn"), n)).drop("__turn")


def salt_hot_keys(df: DataFrame, hot: Column, row_id: Column, shards: int) -> DataFrame:
    """Spread chosen keys over ``key-0`` .. ``key-<shards-1>``; ``base_key`` keeps the original."""
    return df.withColumn("base_key", F.col("key")).withColumn("key", salted_key(F.col("key"), hot, row_id, shards))


def salted_totals(df: DataFrame, value: Column) -> DataFrame:
    """Two-stage aggregate over salted keys: per shard first, then per original key."""
    shards = df.groupBy("base_key", "key").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    return shards.groupBy("base_key").agg(
        F.sum("n").alias("records"), F.sum("s").alias("total"), F.count(F.lit(1)).alias("shards"))

"""How often a plan reads its table: at most twice for one ordered scan, and no more where scans are nested."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from tidelog.operators import audit, queue, timelines, visibility
from tidelog.plans import scans


def reads(df) -> int:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue().split("Initial Plan")[-1].count("FileScan parquet")


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "log")
    spark.range(2000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"), (F.col("id") % 5).alias("producer_id"),
        (F.col("id") % 700).alias("sequence"), F.concat(F.lit("x"), F.col("id") % 9).alias("txn_id"), (F.col("id") % 40).alias("inflight"), F.lit(1).alias("delivery"),
        F.when(F.col("id") % 4 == 0, queue.RENEW).otherwise(queue.ACCEPT).alias("type"), (F.col("id") * 1000).alias("delivered_us"), (F.col("id") * 1000 + 5).alias("acked_us"),
        F.col("id").alias("seq")).write.parquet(path)
    return spark.read.parquet(path)


def test_one_scan(log):
    assert reads(scans.scan(log, ["partition"], ["offset"], scans.id_chunk("offset", 100), n=scans.index(), s=scans.running_sum(F.col("sequence")))) == 2


@pytest.mark.parametrize("name, most, plan", [
    ("dedup_retries", 2, lambda log: audit.dedup_retries(log)),
    ("pause_intervals", 2, lambda log: timelines.pause_intervals(log, ["partition"], "offset", "inflight", 30, 10, 100)),
    ("judge_acks", 2, lambda log: queue.judge_acks(log, ["partition", "offset"], "seq", 2_000_000, 100)),
    ("queue_state", 2, lambda log: queue.queue_state(log, ["partition", "offset"], "seq", 2, 2_000_000, chunk_rows=100)),
    ("fence_zombies", 3, lambda log: visibility.fence_zombies(log.withColumnsRenamed({"txn_id": "transactional_id", "sequence": "epoch", "offset": "log_order"}), chunk_rows=100)),
])
def test_nested_scans_and_aggregates(log, name, most, plan):
    assert 1 <= reads(plan(log)) <= most


def test_visibility_reads_the_log_once_more_for_its_open_starts_at_most(spark, log):
    markers = spark.createDataFrame([(f"x{i}", "commit", 0) for i in range(8)], "txn_id string, outcome string, epoch int")
    assert reads(visibility.read_committed(log, markers)) == 1  # the open starts are facts, fetched before

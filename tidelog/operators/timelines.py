"""Ordered analytics over deliveries, polls, back-pressure and rebalances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.plans import scans
from tidelog.plans.once import materialised

PART = ["topic", "partition"]


def attempt_no(deliveries: DataFrame, ids: Sequence[str], order: str, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """1-based delivery number per record; one record redelivered without end is still cut into chunks."""
    numbered = scans.scan_measured(deliveries, list(ids), order, chunk_rows, __i=scans.index())
    return numbered.withColumn("attempt", F.col("__i") + 1).drop("__i")


def attempt_report(deliveries: DataFrame, ids: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Records, deliveries, redelivered records and the highest delivery number per group. Counts are enough."""
    per_id = deliveries.groupBy(*by, *ids).agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), F.sum("n").alias("deliveries"),
        F.count_if(F.col("n") > 1).alias("redelivered"), F.max("n").alias("max_attempt"))


def poll_overruns(polls: DataFrame, by: Sequence[str], order: str, at_us: str, limit_us: int,
                  chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Gaps between consecutive polls longer than the limit: the worker counts as dead."""
    gaps = scans.scan_measured(polls, list(by), order, chunk_rows, __prev=scans.previous(F.col(at_us)))
    return gaps.withColumn("gap_us", F.col(at_us) - F.col("__prev")).filter(F.col("gap_us") > limit_us).drop("__prev")


def idle_periods(log: DataFrame, gap_us: int, at: Column | None = None,
                 chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Periods of at least ``gap_us`` without a record, per partition."""
    timed = log.select(*PART, "offset", (F.unix_micros("timestamp") if at is None else at).alias("idle_from_us"))
    nexts = scans.scan(timed, PART, ["offset"], scans.id_chunk("offset", chunk_rows),
                       idle_to_us=scans.following(F.col("idle_from_us")))
    return nexts.withColumn("idle_us", F.col("idle_to_us") - F.col("idle_from_us")).filter(F.col("idle_us") >= gap_us)


def pause_intervals(inflight: DataFrame, by: Sequence[str], order: str, value: str, hi: float, lo: float,
                    chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """Hysteresis: paused once the value rises above ``hi``, until it falls below ``lo``. One row per pause.

    Only crossings matter, so rows between the thresholds are dropped first. A crossing that differs from the one
    before is an edge; a pause runs from its edge to the next one.
    """
    by = list(by)
    crossing = F.when(F.col(value) > hi, 1).when(F.col(value) < lo, 0)
    crossings = inflight.select(*by, order, crossing.alias("__x")).filter(F.col("__x").isNotNull())
    edges = scans.scan_measured(crossings, by, order, chunk_rows, __before=scans.previous(F.col("__x"))).filter(
        F.col("__x") != F.coalesce("__before", F.lit(0)))
    # The crossings are few, and both branches of the next scan read them: they are worked out once.
    spans = scans.scan_measured(materialised(edges.drop("__before")), by, order, chunk_rows, resumed_at=scans.following(F.col(order)))
    return spans.filter(F.col("__x") == 1).select(*by, F.col(order).alias("paused_at"), "resumed_at")


def rebalance_cost(events: DataFrame, marks: DataFrame, order: str, chunk_rows: int = scans.CHUNK_ROWS) -> DataFrame:
    """What each member gave up and got between one mark and the next.

    ``events`` has (group, order, member, action, partitions) with action revoked, assigned or LOST; ``marks`` has
    (group, order, mark). Events before the first mark belong to segment 0.
    """
    e = events.select("group", order, "member", "action", F.size("partitions").alias("moved"), F.lit(0).alias("is_mark"))
    m = marks.select("group", order, F.lit(None).cast("string").alias("member"), F.lit(None).cast("string").alias("action"),
                     F.lit(0).alias("moved"), F.lit(1).alias("is_mark"))
    tracked = scans.scan_measured(e.unionByName(m), ["group"], order, chunk_rows,
                                  segment=scans.running_sum(F.col("is_mark")))
    total = lambda action: F.sum(F.when(F.col("action") == action, F.col("moved")).otherwise(0))
    return tracked.filter(F.col("is_mark") == 0).groupBy("group", "segment", "member").agg(
        total("revoked").alias("revoked"), total("LOST").alias("lost"), total("assigned").alias("gained"),
        F.count_if(F.col("action") == "assigned").alias("assignments"),
        (total("assigned") - total("revoked") - total("LOST")).alias("net"))


def timeline(attempts: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n attempts in time order; ``order`` must end in a unique tie-break."""
    return attempts.orderBy(*order).limit(n)


def assignment_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Partitions gained and lost per member between two snapshots of (member, partition)."""
    both = before.select("member", "partition", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("member", "partition", F.lit(0).alias("b"), F.lit(1).alias("a")))
    held = both.groupBy("member", "partition").agg(F.max("b").alias("b"), F.max("a").alias("a"))
    return held.groupBy("member").agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("gained"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("lost"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("kept"))

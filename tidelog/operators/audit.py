"""Delivery audit: what is missing, duplicated, unexpected or already handled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delivery_counts(expected: DataFrame, seen: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per id: how often it was sent and how often it was seen.

    Both sides are counted together, so one partial aggregation precedes the single shuffle and an id repeated
    any number of times travels as one row per task.
    """
    one, zero = F.lit(1), F.lit(0)
    both = expected.select(*ids, one.alias("s"), zero.alias("d")).unionByName(seen.select(*ids, zero.alias("s"), one.alias("d")))
    return both.groupBy(*ids).agg(F.sum("s").alias("sent"), F.sum("d").alias("seen"))


def delivery_audit(expected: DataFrame, seen: DataFrame, ids: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sent, delivered, distinct, missing, repeated ids, extra copies and unexpected ids, in total or per group.

    ``by`` columns must be part of ``ids``. Two duplicate counts exist and both are returned: ids seen more than
    once, and copies beyond the first.
    """
    counts = delivery_counts(expected, seen, ids)
    sent, got = F.col("sent"), F.col("seen")
    return counts.groupBy(*by).agg(
        F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"),
        F.coalesce(F.sum("seen"), F.lit(0)).alias("delivered"),
        F.count_if(got > 0).alias("distinct_seen"),
        F.count_if((sent > 0) & (got == 0)).alias("missing"),
        F.count_if(got > 1).alias("repeated_ids"),
        F.coalesce(F.sum(F.greatest(got - 1, F.lit(0))), F.lit(0)).alias("extra_copies"),
        F.count_if((sent == 0) & (got > 0)).alias("unexpected"))


def skip_handled(df: DataFrame, ledger: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows whose id is not in the ledger, one per id."""
    ids = list(ids)
    return df.dropDuplicates(ids).join(ledger.select(*ids), ids, "left_anti")


def dedup_retries(log: DataFrame, producer: str = "producer_id", sequence: str = "sequence") -> DataFrame:
    """One copy per (producer, partition, sequence): the one with the lowest offset.

    A record without a producer id or sequence number is no retry of anything and stays. One aggregate picks the
    copy with all its columns, so copies of one record collapse before the shuffle."""
    keys = ["topic", "partition", producer, sequence]
    numbered = F.col(producer).isNotNull() & F.col(sequence).isNotNull()
    rest = [c for c in log.columns if c not in keys]
    first = log.filter(numbered).groupBy(*keys).agg(F.min_by(F.struct(*rest), "offset").alias("__row")).select(*keys, "__row.*")
    return first.select(*log.columns).unionByName(log.filter(~numbered))


def eos_check(committed: DataFrame, everything: DataFrame) -> DataFrame:
    """Committed output rows, distinct key@value pairs, duplicates, and all rows including aborted ones."""
    pairs = committed.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    visible = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("committed_rows"), F.count(F.lit(1)).alias("distinct_rows"))
    total = everything.agg(F.count(F.lit(1))).scalar()
    return visible.select(
        "committed_rows", "distinct_rows", (F.col("committed_rows") - F.col("distinct_rows")).alias("duplicates"),
        total.alias("all_rows"))


def reacquired(held: DataFrame, deliveries: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Deliveries to another worker of records that one worker held, with a delivery count above 1."""
    ids = list(ids)
    mine = held.select(*ids, F.col("worker").alias("__holder")).distinct()
    again = deliveries.filter(F.col("delivery") > 1).alias("d")
    condition = [F.col(f"d.{c}") == F.col(f"h.{c}") for c in ids] + [F.col("d.worker") != F.col("h.__holder")]
    return again.join(mine.alias("h"), condition, "left_semi")
